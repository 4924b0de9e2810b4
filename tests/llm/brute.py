"""Plain, slow versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def measures(text):
    text = text or ""
    words, seen, again = SPACED.findall(text), set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(k, k + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def shingles(text, width=5):
    words = SPACED.findall(small(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def near_groups(texts, percent=75):
    """Per row: size of its set and a number for its group."""
    sets = [shingles(text) for text in texts]
    parent = list(range(len(sets)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    index = defaultdict(list)
    for k, own in enumerate(sets):
        common = Counter(j for gram in own for j in index[gram])
        for gram in own:
            index[gram].append(k)
        for j, both in common.items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                parent[top(k)] = top(j)
    return [(len(own), top(k)) for k, own in enumerate(sets)]


def contamination(texts, items):
    """Per text: words, hit words, sorted ids of items with windows in it."""
    windows = defaultdict(set)
    for name, text in items:
        words = PLAIN.findall(small(text))
        m = min(10, len(words))
        for k in range(len(words) - m + 1 if m else 0):
            windows[tuple(words[k : k + m])].add(name)
    out = []
    for text in texts:
        words, hit, found = PLAIN.findall(small(text)), set(), set()
        for m in set(map(len, windows)):
            for k in range(len(words) - m + 1):
                names = windows.get(tuple(words[k : k + m]))
                if names:
                    hit.update(range(k, k + m))
                    found |= names
        out.append((len(words), len(hit), sorted(str(f) for f in found if f is not None)))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    """(start, kind, end) of the base spans, in order of start and kind."""
    out = []
    for place, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            valid = {
                "email": True,
                "ip": kind != "ip" or all(int(part) <= 255 for part in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if valid:
                out.append((m.start(), place, kind, m.end()))
    return [(start, kind, end) for start, _, kind, end in sorted(out)]


def masked(text, spans):
    """`text` with (start, place, end, kind) spans replaced, overlapping ones as one."""
    if text is None:
        return None
    merged = []
    for start, _, end, kind in sorted(spans):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    out, at = "", 0
    for start, end, kind in merged:
        out += text[at:start] + f"[{kind.upper()}]"
        at = end
    return out + text[at:]
