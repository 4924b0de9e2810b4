"""A quality score from compression with two dictionaries.

Text that is like the good (or bad) examples compresses better with a dictionary made
of them. The difference of the two compressed sizes relative to their sum is taken of
the text itself and of its shape (all small letters alike, all capitals, all digits),
which shows marks, capitals and repetition whatever the language. The differences and
the ratios of compression are then set against the labels once more, on examples no
dictionary was made of, which gives a score from 0 to 1.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.frames import stored, text_of

#: Labelled rows of each class that a model is fitted on, at most, by order of a hash
#: of the id; and the bytes of a dictionary, shared evenly by its texts.
SAMPLE = 2000
DICTIONARY_BYTES = 512 * 1024
#: Bytes of a piece, at least; a text's share is made of pieces from all over it.
PIECE = 96
LEVEL = 3
#: Examples kept from the dictionaries for setting the score: one in so many.
CALIBRATION = 3


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: Bytes to their class: letters outside ASCII count as small ones.
_SHAPE = bytes(
    ord("a") if byte >= 0x80 or 0x61 <= byte <= 0x7A
    else ord("A") if 0x41 <= byte <= 0x5A
    else ord("0") if 0x30 <= byte <= 0x39
    else byte
    for byte in range(256)
)


def _views(text: str) -> tuple[bytes, bytes]:
    data = text.encode()
    return data, data.translate(_SHAPE)


@dataclass(frozen=True)
class Model:
    """Good and bad dictionaries for each view, and the weights of the features."""

    dictionaries: tuple[tuple[bytes, bytes], ...]
    weights: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.dictionaries:
            return np.full(len(texts), 0.5)
        x = (_features(texts, self.dictionaries) - self.means) / self.scales
        z = self.weights[0] + x @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@lru_cache(maxsize=16)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=content, write_content_size=False, write_dict_id=False)


def _features(texts: list[str], dictionaries: tuple[tuple[bytes, bytes], ...]) -> np.ndarray:
    """Per text and view: the normalised difference, alone and weighed by how much text
    there is, and the ratio of compression; and how much text there is.
    """
    pairs = [tuple(map(_compressor, pair)) for pair in dictionaries]
    out = np.empty((len(texts), 4 * len(pairs) + 1))
    for k, text in enumerate(texts):
        found = []
        for data, (with_good, with_bad) in zip(_views(text), pairs):
            much = np.log1p(len(data))
            a, b = len(with_good.compress(data)), len(with_bad.compress(data))
            difference, ratio = (b - a) / (a + b), np.log((a + b) / (2 * len(data) + 20))
            found += [difference, difference * much, ratio, ratio * much]
        out[k] = *found, much
    return out


def _pieces(data: bytes, share: int) -> bytes:
    """The text if it is no longer than its share, else pieces at even distances, first to last."""
    if len(data) <= share:
        return data
    count = max(1, (share + 1) // (PIECE + 1))
    size = (share + 1) // count - 1
    last = len(data) - size
    return b"\n".join(data[at : at + size] for at in (last * k // max(1, count - 1) for k in range(count)))


def _pieces_of(text: Column, share: int) -> Column:
    @F.arrow_udf("binary")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array((_pieces(text.as_py().encode(), share) for text in texts), pa.binary())

    return cut(text)


def _features_of(text: Column, dictionaries: tuple[tuple[bytes, bytes], ...]) -> Column:
    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        found = [_features([text.as_py()], dictionaries)[0].tolist() for text in texts]
        return pa.array(found, pa.list_(pa.float64()))

    return features(text)


def _fitted(x: np.ndarray, y: np.ndarray) -> tuple:
    """Logistic regression by Newton's method, lightly regularised."""
    means, scales = x.mean(axis=0), x.std(axis=0) + 1e-9
    rows = np.column_stack([np.ones(len(x)), (x - means) / scales])
    w = np.zeros(rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (p - y) + 1e-2 * w
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w), tuple(means), tuple(scales)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """A model from at most `sample` labelled rows of each class outside the held-out rows.

    Rows without id, text or label are left out. Where a class has no example the
    dictionaries cannot differ, and every score is 0.5.
    """
    own = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"))
    own = own.filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    # More than enough of each class, in case some have no text.
    order = F.xxhash64("id")
    picked = [
        own.filter((F.col("label") == k) & ~held_out("id")).orderBy(order, "id").limit(2 * sample)
        for k in (0, 1)
    ]
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = texts.filter("text IS NOT NULL").join(picked[0].unionByName(picked[1]), "id")
    once = stored(found.groupBy("id", "label").agg(F.first("text").alias("text")))
    # Only ids are ranked, and at most 2 * sample of them kept.
    rank = F.row_number().over(Window.partitionBy("label").orderBy(order, "id"))
    ranked = once.select("id", "label").withColumn("rank", rank).filter(F.col("rank") <= sample)
    place = F.row_number().over(Window.orderBy("rank", "label")) - 1
    places = ranked.select("id", "label", place.alias("place"))
    return _model(stored(once.join(F.broadcast(places), ["id", "label"]).select("place", "label", "text")))


def _model(examples: DataFrame) -> Model:
    """The model of rows of place, label and whole text."""
    kept = examples.filter(F.col("place") % CALIBRATION != 0)
    counts = {row["label"]: row["count"] for row in kept.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model((), (), (), ())
    pair = []
    for wanted in (1, 0):
        share = max(64, DICTIONARY_BYTES // counts[wanted] - 1)
        cut = kept.filter(F.col("label") == wanted).select("place", _pieces_of(F.col("text"), share).alias("pieces"))
        # At most a dictionary's bytes.
        pair.append(b"\n".join(bytes(row["pieces"]) for row in cut.orderBy("place").collect())[:DICTIONARY_BYTES])
    dictionaries = (tuple(pair), tuple(one.translate(_SHAPE) for one in pair))
    rest = examples.filter(F.col("place") % CALIBRATION == 0)
    rest = rest.select("place", "label", _features_of(F.col("text"), dictionaries).alias("x"))
    rows = rest.orderBy("place").collect()  # a few numbers of each
    x = np.array([row["x"] for row in rows])
    return Model(dictionaries, *_fitted(x, np.array([row["label"] for row in rows], float)))


def score(text: Column, model: Model) -> Column:
    """The model's score of a column of text."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        starts = range(0, len(texts), 256)
        parts = [model.scores(texts.slice(k, 256).to_pylist()) for k in starts]
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return scored.asNondeterministic()(text)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out and score, from the whole text.

    One row per input row, repeated rows included. A null text counts as empty; a null
    id is not held out. Other columns are not read.
    """
    return docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        held_out(id_col).alias("held_out"),
        score(text_of(text_col), model).alias("score"),
    )
