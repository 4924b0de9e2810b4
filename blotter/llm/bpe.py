"""Byte-pair encoding and decoding of whole texts with a given tokenizer file.

Long text is encoded as a tree: it is cut in halves down to leaves, the leaves are
encoded on their own, and neighbours are concatenated by encoding a window around
each cut again, growing it until its ends agree token by token with both sides.
Texts above SPREAD characters have their segments encoded by different tasks.

Inside a leaf the tokenizers library encodes each distinct piece (a word with the
white space before it) once per worker. Between a character that is no white space
and white space every encoding has a token boundary, whatever stands around it, so
the pieces' ids are those of the whole.
"""

from __future__ import annotations

import json
import re
import string
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from blotter.llm.frames import give_back, text_of, unused

#: Characters in a leaf of the tree, and in a segment that a task encodes.
LEAF = 4096
SPREAD = 65_536
#: Tokens that must agree on either side of a window, and its first reach in bytes.
AGREE = 4
REACH = 48
#: Characters of text whose pieces are looked up together; of bare words, more.
TOGETHER = 1 << 20
WORDS_TOGETHER = 1 << 23
#: Pieces a worker remembers, bare words, and the longest that it does.
MEMO = 300_000
WORD_MEMO = 1_200_000
MEMO_CHARS = 64

_PIECE = re.compile(r"\s*\S+|\s+")
#: White space to Python but not to the tokenizers' patterns.
_UNLIKE = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Full stops and commas beside what may be one word with them.
_TIGHT = re.compile(r"[.,](?:(?=[^\s\w]|_)|(?<=[^\s\w][.,])|(?<=_[.,]))")
_MARKS = string.punctuation
#: Letters up to here are plain to every version of the patterns; no mark joins them.
_PLAIN_LETTERS = "\u024f"


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others take the characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class PieceEncoder:
    """Encodes texts piece by piece; ids are little-endian unsigned 32-bit integers."""

    together = TOGETHER

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def pieces(self, text: str) -> list[str]:
        return _PIECE.findall(text)

    def stem(self, piece: str) -> str | None:
        """The piece's word if it is letters that make up one word to the tokenizer, else None.

        Marks of ASCII may follow the letters; they are a piece of their own.
        """
        raise NotImplementedError

    def parted(self, stems: list[str]) -> list[bytes]:
        """The ids of each of the words, all of them encoded in one call."""
        raise NotImplementedError

    def _unseen(self, pieces: set[str]) -> set[str]:
        """The pieces that are not remembered; where there is no room, all are forgotten."""
        unseen = pieces.difference(self.memo)
        if len(self.memo) + 2 * len(unseen) > MEMO:
            self.memo.clear()
            return pieces
        return unseen

    def _learn(self, unseen: set[str]) -> None:
        memo = self.memo
        words, marked, others = set(), [], set()
        for piece in unseen:
            stem = self.stem(piece) or self.stem(piece.rstrip(_MARKS))
            if not stem:
                others.add(piece)
                continue
            if stem not in memo:
                words.add(stem)
            if stem != piece:
                marked.append((piece, stem))
        words = list(words)
        for start in range(0, len(words), 8192):
            part = words[start : start + 8192]
            memo.update(zip(part, self.parted(part)))
        tails = [piece[len(stem) :] for piece, stem in marked]
        others = list(others.union(tails).difference(memo, ("",)))
        memo.update(zip(others, self._library(others)))
        for (piece, stem), tail in zip(marked, tails):
            memo[piece] = memo[stem] + (memo[tail] if tail else b"")

    def _known(self, distinct: set[str]) -> dict[str, bytes]:
        """Has the ids of all the pieces; long ones are not remembered."""
        unseen = self._unseen(distinct)
        long = [piece for piece in unseen if len(piece) > MEMO_CHARS]
        self._learn(unseen.difference(long))
        return self.memo | dict(zip(long, self._library(long))) if long else self.memo

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the library gives them for the whole text."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size < self.together):
                size += len(texts[end])
                end += 1
            out += self._encode_some(texts[start:end])
            start = end
        return out

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        split = [None if _unlike(text) else self.pieces(text) for text in texts]
        look = self._known(set().union(*(pieces for pieces in split if pieces))).__getitem__
        return [
            self._library([text])[0] if pieces is None else b"".join(map(look, pieces))
            for text, pieces in zip(texts, split)
        ]


class ByteEncoder(PieceEncoder):
    """A byte-level vocabulary that keeps white space: its tokens' bytes make up the text."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        to_byte = byte_characters()
        size = self.tokenizer.get_vocab_size()
        self.token_bytes = [b""] * size
        for token, number in described["model"]["vocab"].items():
            self.token_bytes[number] = bytes(to_byte[c] for c in token)
        self.specials = []
        for added in described["added_tokens"]:
            content = added["content"].encode()
            self.token_bytes[added["id"]] = content
            self.specials.append(content)
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)

    def stem(self, piece: str) -> str | None:
        plain = piece[:1] == " " and piece[1:].isalpha() and max(piece) <= _PLAIN_LETTERS
        return piece if plain else None

    def parted(self, stems: list[str]) -> list[bytes]:
        ids = np.frombuffer(self._library(["".join(stems)])[0], "<u4")
        ends = np.cumsum(self.lengths[ids])
        stops = np.searchsorted(ends, np.cumsum([len(stem.encode()) for stem in stems])) + 1
        return _cut(ids, stops)

    def decode(self, ids: bytes) -> str:
        table = self.token_bytes
        found = b"".join([table[k] for k in np.frombuffer(ids, "<u4").tolist()])
        return found.decode("utf-8", "replace")

    def _splits(self, data: bytes, place: int) -> bool:
        """Whether a place lies inside a character or a special token."""
        if 0 < place < len(data) and data[place] & 0xC0 == 0x80:
            return True
        return any(
            data.find(s, max(0, place - len(s) + 1), place + len(s) - 1) >= 0 for s in self.specials
        )

    def joined(self, data: bytes, cut: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of `data` from those of its parts before and after `cut`.

        A window around the cut is encoded again and doubled until its first and
        last AGREE tokens are those of the two sides, or it has all of a side.
        """
        if not len(left) or not len(right):
            return left if len(left) else right
        reach = REACH
        while True:
            # Only the tokens within reach are looked at, not the whole sides.
            near, far = left[-reach:], right[:reach]
            ends = cut - np.cumsum(self.lengths[near][::-1])[::-1]
            first = max(0, int(np.searchsorted(ends, cut - reach, "right")) - 1)
            stops = cut + np.cumsum(self.lengths[far])
            last = min(int(np.searchsorted(stops, cut + reach)), len(far) - 1)
            while first > 0 and self._splits(data, int(ends[first])):
                first -= 1
            while last < len(far) - 1 and self._splits(data, int(stops[last])):
                last += 1
            i, j = len(left) - len(near) + first, last + 1
            whole_left, whole_right = i == 0, j == len(right)
            start, end = int(ends[first]), int(stops[last])
            if not (self._splits(data, start) or self._splits(data, end)):
                window = data[start:end].decode()
                found = np.frombuffer(self.encode([window])[0], "<u4")
                if (whole_left or np.array_equal(found[:AGREE], left[i : i + AGREE])) and (
                    whole_right or np.array_equal(found[-AGREE:], right[max(0, j - AGREE) : j])
                ):
                    return np.concatenate([left[:i], found, right[j:]])
            reach *= 2

    def concatenated(self, parts: list[str], ids: list[bytes]) -> bytes:
        """The ids of the parts' concatenation: neighbours are joined level by level."""
        level = [(part.encode(), np.frombuffer(one, "<u4")) for part, one in zip(parts, ids)]
        while len(level) > 1:
            above = [
                (a + b, self.joined(a + b, len(a), x, y))
                for (a, x), (b, y) in zip(level[::2], level[1::2])
            ]
            level = above + level[len(above) * 2 :]
        return level[0][1].astype("<u4").tobytes() if level else b""

    def encode_tree(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, long ones by way of their leaves."""
        leaves = [_halves(text) for text in texts]
        flat = iter(self.encode([leaf for own in leaves for leaf in own]))
        return [self.concatenated(own, [next(flat) for _ in own]) for own in leaves]


class WordEncoder(PieceEncoder):
    """A vocabulary with word ends that drops white space, so pieces are bare words.

    The ids of words are remembered in two generations. Arrow splits texts and numbers
    their distinct words, so that only these become Python objects and are looked up.
    """

    together = WORDS_TOGETHER

    def __init__(self, path: str):
        super().__init__(path)
        #: The model alone, for words that need neither normalizing nor splitting.
        self.model = self.tokenizer.model
        self.byte_names = {byte: name for name, byte in byte_characters().items()}
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            ends[number] = token.endswith("</w>")
        self.word_ends = ends
        self.older: dict[str, bytes] = {}

    def _unseen(self, pieces: set[str]) -> set[str]:
        """The pieces that neither generation has; those of the older one come back.

        A younger generation that is full becomes the older one.
        """
        unseen = pieces.difference(self.memo)
        if len(self.memo) + 2 * len(unseen) > WORD_MEMO // 2:
            self.older, self.memo = self.memo, {}
            unseen = pieces
        met = unseen.intersection(self.older)
        self.memo.update((piece, self.older[piece]) for piece in met)
        return unseen - met

    def pieces(self, text: str) -> list[str]:
        return self.eased(text).split()

    def eased(self, text: str) -> str:
        """The text in small letters and with full stops and commas apart where that is sure
        to leave the ids as they are: it lets more words share one encoding.
        """
        low = text.lower()
        if "<|" not in text and "\u03a3" not in text and unicodedata.is_normalized("NFC", low):
            text = low
            if not _TIGHT.search(text):
                text = text.replace(".", " . ").replace(",", " , ")
        return text

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        whole = {k for k, text in enumerate(texts) if _unlike(text)}
        eased = ["" if k in whole else self.eased(text) for k, text in enumerate(texts)]
        words = pc.utf8_split_whitespace(pa.array(eased, pa.large_string()))
        coded = words.values.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self._known({word for word in distinct if word})
        # White space at an end of a text leaves an empty word there.
        ids = [known[word] if word else b"" for word in distinct]
        # The ids of all words in a row, and where those of each text begin.
        joined = pa.array(ids, pa.large_binary()).take(coded.indices)
        _, places, data = joined.buffers()
        starts = np.frombuffer(places, "<i8", len(joined) + 1)[words.offsets.to_numpy()].tolist()
        raw = memoryview(data or b"")
        out = [bytes(raw[start:end]) for start, end in zip(starts, starts[1:])]
        for k in whole:
            out[k] = self._library([texts[k]])[0]
        return out

    def stem(self, piece: str) -> str | None:
        if not piece.isalpha() or not (piece.isascii() or max(piece) <= _PLAIN_LETTERS):
            return None
        low = piece.lower()
        if low == piece:
            return piece
        return low if len(low) == len(piece) else None

    def parted(self, stems: list[str]) -> list[bytes]:
        tokens, names = self.model.tokenize, self.byte_names
        written = [
            stem if stem.isascii() else stem.encode().decode("latin-1").translate(names)
            for stem in stems
        ]
        ids = np.array([token.id for word in written for token in tokens(word)], np.uint32)
        return _cut(ids, np.flatnonzero(self.word_ends[ids]) + 1)


def _unlike(text: str) -> bool:
    return any(mark in text for mark in _UNLIKE)


def _cut(ids: np.ndarray, stops: np.ndarray) -> list[bytes]:
    raw, at, out = ids.tobytes(), 0, []
    for stop in (stops * 4).tolist():
        out.append(raw[at:stop])
        at = stop
    return out


def _halves(text: str) -> list[str]:
    """The text in equal parts of at most LEAF characters, by repeated halving."""
    parts = [text]
    while len(parts[0]) > LEAF:
        parts = [half for p in parts for half in (p[: (len(p) + 1) // 2], p[(len(p) + 1) // 2 :])]
    return parts


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that few are Python objects at once."""
    for batch in batches:
        for start in range(0, len(batch), 256):
            yield batch.slice(start, 256)
        pa.default_memory_pool().release_unused()
    give_back()


def _with(batch: pa.RecordBatch, drop: str, **columns: pa.Array) -> pa.RecordBatch:
    """The batch without one column and with others."""
    kept = [name for name in batch.schema.names if name != drop]
    arrays = [*[batch[name] for name in kept], *columns.values()]
    return pa.RecordBatch.from_arrays(arrays, [*kept, *columns])


def _coded(
    rows: DataFrame, text: str, path: str, ids_col: str, decoded_col: str | None
) -> DataFrame:
    """`rows` with the ids of column `text`, and the text of the ids, in its place."""
    fields = [field for field in rows.schema.fields if field.name != text]
    fields.append(T.StructField(ids_col, T.BinaryType()))
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType()))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_encoder(path)
        for batch in _slices(batches):
            ids = coder.encode_tree(batch[text].to_pylist())
            made = {ids_col: pa.array(ids, pa.binary())}
            if decoded_col:
                made[decoded_col] = pa.array(map(coder.decode, ids), pa.string())
            yield _with(batch, text, **made)

    return rows.mapInArrow(code, T.StructType(fields))


def decoded(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """`rows` with the text of a column of ids; bytes that are no UTF-8 become U+FFFD.

    Null has no ids and gives an empty text. A column of the name `text_col` is replaced.
    """
    rows = rows.drop(text_col)
    fields = [*rows.schema.fields, T.StructField(text_col, T.StringType())]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_encoder(path)
        for batch in _slices(batches):
            texts = [coder.decode(ids or b"") for ids in batch[ids_col].to_pylist()]
            yield _with(batch, "", **{text_col: pa.array(texts, pa.string())})

    return rows.mapInArrow(decode, T.StructType(fields))


def encoded(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str | None = None,
) -> DataFrame:
    """`docs` with the column `ids_col`: the whole text's ids, little-endian 32 bits each.

    With `decoded_col`, also the text that the ids decode to. A null text counts as
    empty and has no ids. Repeated rows stay. Texts of more than SPREAD characters are
    cut into segments, each distinct text once; tasks encode the segments, and one task
    per text concatenates their ids. Columns of the new ones' names are replaced.
    """
    made = [ids_col, *([decoded_col] if decoded_col else [])]
    own, key = unused(docs, "_text"), unused(docs, "_key")
    texts = docs.withColumn(own, text_of(text_col)).drop(*made)
    is_long = F.length(own) > SPREAD
    short = _coded(texts.filter(~is_long), own, path, ids_col, decoded_col)

    long = texts.filter(is_long).withColumn(key, F.sha2(own, 256))
    once = long.groupBy(F.col(key).alias("key")).agg(F.first(own).alias("text"))
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{SPREAD}}}"), F.lit(0))
    segments = once.select("key", F.posexplode(cut).alias("place", "part"))
    segments = segments.withColumn("text", F.col("part")).repartition("key", "place")
    segments = _coded(segments, "text", path, "ids", None)

    def concatenate(group: pa.Table) -> pa.Table:
        coder, rows = byte_encoder(path), group.sort_by("place")
        ids = coder.concatenated(rows["part"].to_pylist(), rows["ids"].to_pylist())
        columns = {key: rows["key"].slice(0, 1), ids_col: pa.array([ids], pa.binary())}
        if decoded_col:
            columns[decoded_col] = pa.array([coder.decode(ids)], pa.string())
        return pa.table(columns)

    kind = f"`{key}` string, `{ids_col}` binary"
    if decoded_col:
        kind += f", `{decoded_col}` string"
    whole = segments.groupBy("key").applyInArrow(concatenate, kind)
    names = [F.col(f"`{name}`") for name in short.columns]
    return short.unionByName(long.drop(own).join(whole, key).select(*names))
