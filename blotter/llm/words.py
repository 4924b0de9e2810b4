"""Words of whole Arrow columns of text, found and hashed by array operations.

A column is worked through in blocks of whole rows, each of about BLOCK bytes (more
only where a single text is longer), so memory stays bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19

# Bytes of words by two patterns. Every byte from 0x80 on is part of a letter
# outside ASCII and belongs to a word in both.
#: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
PLAIN = np.ones(256, bool)
PLAIN[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

#: ASCII capitals to small letters, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_MULTIPLIER = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, np.uint64)
_CYCLE = 1 << 16


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads each of the hashes' bits over all 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 256), _MULTIPLIER, np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


_SHORT = 512
#: By k: the lowest k bytes of a 64-bit value.
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each of the ascending, disjoint segments."""
    lengths = ends - starts
    out = lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    long = lengths > _SHORT
    if not long.any():
        return mixed(_eights(data, starts, lengths, out))
    out[~long] = _eights(data, starts[~long], lengths[~long], out[~long])
    out[long] += _bytewise(data, starts[long], lengths[long])
    return mixed(out)


def _eights(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Takes in eight bytes of every segment at a time, while segments last."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    values = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    h = h.copy()
    live, at, left = np.arange(len(starts)), starts, lengths
    while True:
        some = left > 0
        if not some.all():
            live, at, left = live[some], at[some], left[some]
        if not len(live):
            return h
        taken = values[at] & _LOWEST[np.minimum(left, 8)]
        h[live] = mixed(h[live] ^ taken) * np.uint64(_MULTIPLIER)
        at, left = at + 8, left - 8


def _bytewise(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of the bytes times powers of a multiplier, for segments of any length."""
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(firsts, lengths)
    values = data[np.repeat(starts, lengths) + place].astype(np.uint64) + np.uint64(1)
    longest = int(lengths.max())
    if longest > _CYCLE:
        values += (place >> 16).astype(np.uint64) * np.uint64(0x1000003)
        place &= _CYCLE - 1
    values *= _powers(min(longest, _CYCLE))[place]
    return np.add.reduceat(values, firsts)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each `width` consecutive word hashes, in order."""
    n = max(0, len(hashes) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * _powers(width + 2)[k + 1]
    return mixed(total + np.uint64(width))


@dataclass
class Block:
    """Rows [first, first + rows) of a column: their bytes, and where each row begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Flagged bytes by row."""
        return self.per_span(flags, self.offsets[:-1], self.offsets[1:])

    @staticmethod
    def per_span(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Flagged bytes by byte range."""
        total = np.zeros(len(flags) + 1, np.int32)
        np.cumsum(flags, out=total[1:])
        return total[ends] - total[starts]


@dataclass
class Words:
    """Words of a block, in order: byte range and row of each; first word of each row."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    firsts: np.ndarray


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[Block]:
    """The column in blocks of whole rows. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, content = column.buffers()
    if len(column) == 0:
        return
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    content = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        own = offsets[first : last + 1]
        yield Block(first, content[own[0] : own[-1]], own - own[0])
        first = last


def words_of(block: Block, inside: np.ndarray) -> Words:
    """The runs of flagged bytes, cut where a row ends."""
    n = len(block.data)
    edge = np.zeros(n + 1, bool)
    edge[block.offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    firsts = np.searchsorted(starts, block.offsets)
    rows = np.repeat(np.arange(block.rows), np.diff(firsts))
    return Words(starts, ends, rows, firsts)
