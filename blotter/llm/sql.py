"""SQL counterparts of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_SPACED = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _small(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


OP5 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_small('text')}, '{_PLAIN}') AS w FROM documents),
item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_small('text')}, '{_PLAIN}') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m,
         array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, i, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM words, (SELECT DISTINCT m FROM item_windows) WHERE len(w) >= m)),
found AS (
  SELECT doc_id, i, d.m, item_id FROM doc_windows d JOIN item_windows USING (m, g)),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM found)
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit,
       coalesce(items.n, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP6 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_small('text')}, '{_SPACED}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM words
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x)
LEFT JOIN sizes USING (doc_id)"""

OP7 = f"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_SPACED}')) AS l
  FROM documents),
places AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
twice AS (
  SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM twice)
  GROUP BY doc_id),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(l) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Z].*[A-Z]') AND NOT regexp_matches(x, '[a-z]')))
           AS n_shouted,
         len(list_filter(w, lambda x: regexp_matches(x, '(\\.\\.|\\?\\?|!!|::|;;)$'))) AS n_marked
  FROM words LEFT JOIN repeats USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 20 * n_words
            OR (n_lines > 0 AND 100 * n_dup_lines > 50 * n_lines)
            OR 100 * n_shouted > 30 * n_words OR 100 * n_marked > 20 * n_words
            OR word_chars > 14 * n_words OR word_chars < 2 * n_words) AS kept
FROM judged"""


_SCORE = "CAST(CAST({0} AS HUGEINT) * {0} * 1000000 // (CAST({1} AS HUGEINT) * {2}) AS BIGINT)"

OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_small('text')}, '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents),
words AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
each AS (SELECT lang, p, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM words),
grams AS (
  SELECT lang, w1, lead(w1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3
  FROM each WINDOW piece AS (PARTITION BY p ORDER BY i)),
f1 AS (SELECT lang, w1, count(*) AS f FROM grams GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM grams WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
hidden AS (
  SELECT lang, w1, w2, max(f) AS longer
  FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
two AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r,
         {_SCORE.format('f2.f', 'x.f', 'y.f')} AS score
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  LEFT JOIN hidden h ON h.lang = f2.lang AND h.w1 = f2.w1 AND h.w2 = f2.w2
  WHERE f2.f >= 10 AND (longer IS NULL OR 100 * longer < 50 * f2.f)),
cuts AS (
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
         {_SCORE.format('f3.f', 'x.f', 'yz.f')} AS s1, {_SCORE.format('f3.f', 'xy.f', 'z.f')} AS s2
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f1 z ON z.lang = f3.lang AND z.w1 = f3.w3
  JOIN f2 xy ON xy.lang = f3.lang AND xy.w1 = f3.w1 AND xy.w2 = f3.w2
  JOIN f2 yz ON yz.lang = f3.lang AND yz.w1 = f3.w2 AND yz.w2 = f3.w3),
three AS (
  SELECT lang, phrase, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END AS l, CASE WHEN s2 < s1 THEN r2 ELSE r1 END AS r,
         least(s1, s2) AS score FROM cuts)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM (SELECT * FROM two UNION ALL SELECT * FROM three) JOIN n USING (lang) QUALIFY rank <= 2000"""

# crc32 by its table of 256 steps, over the bytes of `<doc_id>:<run>`.
OP13 = f"""
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_small('text')}, '[a-z\u00C0-\u00FF]{{5,}}')) AS run FROM documents)
  GROUP BY ALL),
bytes AS (SELECT run, n, hex(encode(concat(doc_id, ':', run))) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2),
      lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT))),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h
  FROM bytes, steps),
found AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
        FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
without AS (
  SELECT word, n, k, word[1:k] || word[k + 2:] AS rest
  FROM (SELECT *, unnest(range(length(word))) AS k FROM found)),
pairs AS (
  SELECT x.word AS a, y.word AS b, y.n AS b_n FROM without x JOIN without y USING (k, rest) WHERE x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM without x JOIN found y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM without x JOIN found y ON x.rest = y.word),
nearest AS (
  SELECT a AS word, count(*) AS n_near, max(b_n) AS most FROM pairs GROUP BY a),
formed AS (
  SELECT f.word, f.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN most >= 2 * f.n THEN most END AS form_n,
         CASE WHEN most >= 2 * f.n THEN (SELECT decode(min(encode(b))) FROM pairs WHERE a = f.word AND b_n = most) END AS form
  FROM found f LEFT JOIN nearest USING (word)),
ways AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT w.word, f.word, f.form FROM ways w JOIN formed f ON f.word = w.next)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM ways WHERE next IS NULL) USING (word)"""


def _secrets() -> str:
    """Base matches by plain patterns; entropies counted anew for every window."""
    assign = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    assign = assign.replace("'", "''")
    kinds = [("assign", assign), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]{24,}")]
    classes = {"entropy_hex": ("0-9A-Fa-f", 3.2), "entropy_upper": ("0-9A-Z", 3.6), "entropy_base64": ("0-9A-Za-z+/_=-", 3.9)}
    kinds += [(kind, f"[{listed}]{{20,}}") for kind, (listed, _) in classes.items()]
    matches = "\nUNION ALL ".join(
        f"SELECT r, {k} AS kind, regexp_extract_all(t, '{p}') AS found, string_split_regex(t, '{p}') AS gaps FROM docs"
        for k, (_, p) in enumerate(kinds)
    )
    names = ", ".join(f"'{kind}'" for kind, _ in kinds)
    limits = "".join(f" WHEN {k} THEN {bits}" for k, (_, bits) in enumerate(classes.values(), 3))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({matches}),
each AS (
  SELECT r, kind, unnest(found) AS found, unnest(gaps[:len(found)]) AS gap, unnest(range(len(found))) AS place
  FROM matches WHERE len(found) > 0),
placed AS (
  SELECT *, CAST(sum(length(gap) + length(found)) OVER (PARTITION BY r, kind ORDER BY place) - length(found) AS BIGINT)
    AS b, right(gap, 40) AS l FROM each),
base AS (
  SELECT r, b, kind, b + length(found) AS e FROM placed
  WHERE (kind = 0 AND length(regexp_extract(found, '{assign}', 1)) >= 6) OR (kind = 1 AND length(found) >= 20) OR kind = 2),
strings AS (
  SELECT r, kind, b, string_split(found, '') AS c FROM placed
  WHERE kind > 2 AND regexp_matches(found, '[0-9]') AND regexp_matches(found, '[A-Za-z]')
    AND NOT regexp_full_match(found, '[0-9A-Fa-f]{{8}}(-[0-9A-Fa-f]{{4}}){{3}}-[0-9A-Fa-f]{{12}}')
    AND NOT regexp_matches(found, '(?i)abcdefgh|01234567|12345678|qwertyui|example|sample|placeholder|changeme|dummy|x{{6}}')
    AND NOT regexp_full_match(found, '([A-Za-z]*[0-9]{{0,4}}[+/_=-])*[A-Za-z]*[0-9]{{0,4}}')
    AND NOT regexp_matches(l, '(?i)(sha-?(1|224|256|384|512)|md5|commit|revision|checksum)["'']?[\x20:=-]{{0,4}}["'']?$')),
windows AS (
  SELECT r, kind, b, i, list_histogram(c[i + 1:i + 20]) AS h
  FROM (SELECT *, unnest(range(len(c) - 19)) AS i FROM strings)),
hot AS (
  SELECT r, kind, b + min(i) AS b, b + max(i) + 20 AS e FROM windows
  WHERE list_sum(list_transform(map_values(h), lambda n: CAST(round(n * log2(n) * 1000000) AS BIGINT)))
    <= floor(20 * (log2(20) - CASE kind{limits} END) * 1000000)
  GROUP BY r, kind, windows.b),
found AS (
  SELECT r, b, kind, e, kind < 3 AS base, (ARRAY[{names}])[kind + 1] || ':' || b || ':' || e AS listed
  FROM (SELECT r, b, kind, e FROM base UNION ALL SELECT r, b, kind, e FROM hot)),
by_row AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, string_agg(listed, ',' ORDER BY b, kind, e) FILTER (base) AS own,
         string_agg(listed, ',' ORDER BY b, kind, e) AS spans
  FROM found GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN by_row USING (r)"""


OP12 = _secrets()


def oracle_sql() -> dict[str, str]:
    return {
        "op5_decontaminate": OP5,
        "op6_ngram_join": OP6,
        "op7_quality_rules": OP7,
        "op11_collocations": OP11,
        "op12_secret_scan": OP12,
        "op13_spelling": OP13,
    }
