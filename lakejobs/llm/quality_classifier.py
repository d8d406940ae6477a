"""Text quality by compression: which of two dictionaries, of good or of bad text, makes a text smaller.

A bounded sample of labelled rows is divided in two. From the texts of one half zstandard trains a
dictionary per label. A text is cut into pieces, each piece is compressed by itself with both dictionaries, and the
difference of the two sums of sizes over the text's size is what is measured: every part of a long text counts
alike, as no piece can lean on the text before it. The other half says how that turns into a probability (a
logistic curve). Model and bounds have a fixed size; every row of the table is scored from its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class QualityParams:
    """Bounds of the sample: labelled rows per label, pieces of text per dictionary, characters per piece.

    The curve is fitted on at most `sample_rows` texts per label as well. Texts are compressed in pieces of
    `piece_chars` bytes; a last piece of less than half of that stays with the one before.
    Rows with `crc32(doc_id as text) mod held_out_of = 0` are never learned from. A text is
    predicted good from a score of `accept` on.
    """

    sample_rows: int = 3000
    pieces: int = 4000
    piece_chars: int = 2000
    dictionary_bytes: int = 112_640
    level: int = 3
    held_out_of: int = 5
    accept: float = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the curve; without dictionaries every text scores one half."""

    good: bytes
    bad: bytes
    slope: float
    shift: float
    params: QualityParams

    def measure(self, texts: pa.Array) -> np.ndarray:
        """(size with the bad dictionary - size with the good one) / size of the text; 0 for an empty text."""
        good, bad = (_compressor(x, self.params.level) for x in (self.good, self.bad))
        out = np.zeros(len(texts))
        size = self.params.piece_chars
        for i, text in enumerate(texts):
            body = memoryview(text.as_buffer()) if text.is_valid else b""
            more = 0
            starts = range(0, max(len(body) - size // 2, min(len(body), 1)), size)
            for at in starts:
                piece = body[at : len(body) if at == starts[-1] else at + size]
                more += len(bad.compress(piece)) - len(good.compress(piece))
            if more:
                out[i] = more / len(body)
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        if not self.good or not self.bad:
            return np.full(len(texts), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.measure(texts) + self.shift, -500, 500)))


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        level=level,
        dict_data=zstandard.ZstdCompressionDict(dictionary),
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )


def held_out(doc_id: Column, of: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == 0, F.lit(False))


def _dictionary(pieces: list[bytes], params: QualityParams) -> bytes:
    if not pieces:
        return b""
    try:
        return zstandard.train_dictionary(params.dictionary_bytes, pieces).as_bytes()
    except zstandard.ZstdError:
        # Too little text to train on: the text itself is the dictionary.
        return b"\n".join(pieces)[: params.dictionary_bytes]


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of one measure, a little drawn to zero, by Newton's method."""
    if not len(x) or y.min() == y.max():
        return 0.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    scale = max(float(np.abs(x).mean()), 1e-9)
    rows = np.stack([x / scale, np.ones(len(x))], axis=1)
    weights, pull = np.zeros(2), np.array([1e-2, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -500, 500)))
        slope = rows.T @ (p - y) + pull * weights
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(pull)
        step = np.linalg.solve(bend, slope)
        weights = weights - step / max(1.0, float(np.abs(step).max()) / 4)
        if np.abs(step).max() < 1e-10:
            break
    return float(weights[0] / scale), float(weights[1])


def train_quality(docs: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> QualityModel:
    """Learn from labelled rows that are not held out. Labels other than 0 and 1, and contradictory ones, do not count.

    What comes to the driver is bounded by `params`: sampled ids, pieces of their texts, and one number per row.
    """
    params = params or QualityParams()
    spark = docs.sparkSession
    known = (
        labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), params.held_out_of))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
        .filter("doc_id IS NOT NULL AND label = most")
        .select("doc_id", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id").alias("draw"))
    )
    sample = [known.filter(F.col("label") == label).orderBy("draw").limit(params.sample_rows) for label in (0, 1)]
    rows = sample[0].union(sample[1]).toArrow()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(spark.createDataFrame(rows, "doc_id long, label int, draw long")), "doc_id"
    )
    half = F.pmod(F.xxhash64("draw"), F.lit(2))
    size = params.piece_chars
    starts = F.sequence(F.lit(1), F.length("text"), F.lit(size))
    cut = F.explode(F.transform(starts, lambda at: F.substring("text", at, size)))
    pieces = texts.filter((half == 0) & (F.length("text") > 0)).select("label", cut.alias("piece"))
    pieces = pieces.withColumn("draw", F.xxhash64("piece"))
    parts: list[list[bytes]] = []
    for label in (0, 1):
        drawn = pieces.filter(F.col("label") == label).orderBy("draw", "piece").limit(params.pieces)
        parts.append([x.encode() for x in drawn.select("piece").toArrow().column(0).to_pylist()])
    bad, good = (_dictionary(x, params) for x in parts)
    model = QualityModel(good, bad, 1.0, 0.0, params)
    if not good or not bad:
        return model

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(model.measure(batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("draw"), x], ["label", "draw", "x"])

    # Rows that repeat an id can be more than were sampled; each label has its own bound, so neither crowds out the other.
    rest = texts.filter(half == 1).select("label", F.xxhash64("text").alias("draw"), "text")
    rated = [
        rest.filter(F.col("label") == label).mapInArrow(measure, "label int, draw long, x double")
        .orderBy("draw", "x").limit(params.sample_rows).select("label", "x").toArrow()
        for label in (0, 1)
    ]
    x, y = (np.concatenate([np.asarray(part.column(name), float) for part in rated]) for name in ("x", "label"))
    slope, shift = _curve(x, y)
    return QualityModel(good, bad, slope, shift, params)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    `docs` needs `doc_id` and `text`; other columns are ignored. Null and empty texts get the score of a
    text that both dictionaries treat alike. Repeated rows give repeated results. A null `doc_id` stays
    null and is not held out. If one label is missing from the sample, every score is 0.5.
    """
    params = model.params

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.score(batch.column("text"))
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(values, pa.float64())]
            columns.append(pa.array((values >= params.accept).astype(np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out(F.col("doc_id"), params.held_out_of).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents predicted good, with all their columns as they were."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = model.score(batch.column("text")) >= model.params.accept
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
