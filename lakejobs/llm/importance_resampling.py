"""Documents drawn by how much their n-grams are those of a target: importance resampling with hashed n-grams.

1. In the task that reads them, a batch's n-grams are interned in an open-addressed table. A slot stores its
   n-gram's bucket and how often it occurs in the batch; slots' counts are summed by bucket before the shuffle.
2. A bucket's gain is the logarithm of its share among the target's n-grams over its share among all documents'.
3. Documents are read once more; the slots of their n-grams gather the gains, which add up to a document's weight.
4. Noise that depends on the document's id alone makes the highest scores a draw without replacement. Scores, not
   texts, are range-partitioned and numbered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.llm.shared import chunks, keep, text_bytes
from lakejobs.llm.slots import SlotTable
from lakejobs.llm.words import ALPHANUMERIC, spans
from lakejobs.operators.batching import number_rows
from lakejobs.session import scratch, stage

_SPACE = 32
# What a text's n-grams number at most in one table; longer texts are taken in parts.
_SLAB = 400_000


@dataclass(frozen=True)
class ResamplingParams:
    """N-grams of `least` to `most` words in `buckets` buckets; `percent` of the documents of `min_words` words are drawn."""

    least: int = 1
    most: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    seed: str = "2024"


def joined_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words, lower-cased, with one space after each: the bytes, words' starts and ends, and each text's first word."""
    data, offsets = text_bytes(texts)
    starts, ends, first = spans(data, offsets, ALPHANUMERIC)
    sizes = ends - starts + 1
    places = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(places[-1], _SPACE, np.uint8)
    inside = np.repeat(starts - places[:-1], sizes) + np.arange(len(out))
    last = places[1:] - 1
    inside[last] = 0
    if len(out):
        out[:] = data[inside]
        out[last] = _SPACE
    capital = (out >= 65) & (out <= 90)
    out[capital] += 32
    return out, places[:-1], last, first


def _slabs(first: np.ndarray, n_words: int, params: ResamplingParams) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first word, last word) of all n-grams, in arrays of bounded size."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for size in range(params.least, params.most + 1):
        for low in range(0, n_words, _SLAB):
            word = np.arange(low, min(low + _SLAB, n_words))
            word = word[word + size <= first[1:][text[word]]]
            yield text[word], word, word + size - 1


def interned(texts: pa.Array, params: ResamplingParams) -> Iterator[tuple[np.ndarray, np.ndarray, SlotTable, np.ndarray]]:
    """Slab by slab: the text of each n-gram, its slot, the table, and the table's buckets by slot."""
    data, starts, ends, first = joined_words(texts)
    for text, head, tail in _slabs(first, len(starts), params):
        table = SlotTable(data, starts[head], ends[tail])
        buckets = np.zeros(table.size, np.int64)
        taken = table.taken()
        own = table.owner[taken]
        body = memoryview(data)
        pairs = zip(starts[head][own].tolist(), ends[tail][own].tolist(), strict=True)
        buckets[taken] = np.fromiter((zlib.crc32(body[a:b]) % params.buckets for a, b in pairs), np.int64, len(own))
        yield text, table.slots, table, buckets


def bucket_counts(texts: DataFrame, params: ResamplingParams) -> DataFrame:
    """(bucket, n): the n-grams of all texts by bucket, repeats counted; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(params.buckets, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                for _, _, table, buckets in interned(part.column("text"), params):
                    taken = table.taken()
                    np.add.at(total, buckets[taken], table.count[taken])
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, params: ResamplingParams) -> list[int]:
    """The gain of each bucket; a row per bucket, whatever the size of the tables."""
    s, t = (bucket_counts(x, params).withColumnRenamed("n", name) for x, name in ((docs, "s"), (target, "t")))
    own = docs.sparkSession.range(params.buckets).withColumnRenamed("id", "bucket")
    rows = own.join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"])
    rows = stage(rows, "resampling-buckets")
    totals = rows.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t"))
    share = (F.col("t") + 1) * (F.col("all_s") + params.buckets) / ((F.col("s") + 1) * (F.col("all_t") + params.buckets))
    gain = F.floor(1000 * F.ln(share)).alias("gain")
    found = rows.join(F.broadcast(totals)).select("bucket", gain).toArrow().sort_by("bucket")
    return found.column("gain").to_pylist()


def weights(docs: DataFrame, gains: list[int], params: ResamplingParams) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(np.array(gains, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = part.column("text")
                data, offsets = text_bytes(texts)
                words = np.diff(spans(data, offsets, ALPHANUMERIC)[2])
                features, weight = (np.zeros(part.num_rows, np.int64) for _ in range(2))
                for text, slots, _, buckets in interned(texts, params):
                    features += np.bincount(text, minlength=len(features))
                    np.add.at(weight, text, gain[buckets][slots])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, features, weight))],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    counts = [T.StructField(x, T.LongType()) for x in ("n_words", "n_features", "weight")]
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], *counts]))


def resample(docs: DataFrame, target: DataFrame, params: ResamplingParams | None = None) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    `docs` needs `doc_id` and `text`, `target` needs `text`; other columns are ignored. A null text has no words:
    no features, weight 0. Of the N documents of `min_words` words or more, `percent` percent (rounded down) are
    drawn, highest score first, ties by smaller `doc_id`; `rank` counts them from 1 and is null for all others.
    Rows that repeat a `doc_id` are documents of their own. Of rows with a null `doc_id` the words count like all
    others', but as noise comes from the id, their score is null and they are neither drawn nor counted in N. Without
    any n-grams all gains are 0. An empty table of documents gives no rows.
    """
    params = params or ResamplingParams()
    with scratch(docs.sparkSession):
        gains = bucket_gains(docs, target, params)
        head = F.substring(F.sha2(F.concat(F.lit(f"{params.seed}:"), F.col("doc_id").cast("string")), 256), 1, 8)
        unit = (F.conv(head, 16, 10).cast("double") + 0.5) / 4294967296
        noise = F.floor(-1000 * F.ln(-F.ln(unit)))
        scored = weights(docs, gains, params).withColumn("score", F.col("weight") + noise)
        scored = stage(scored, "resampling-scores")
        eligible = F.col("doc_id").isNotNull() & (F.col("n_words") >= params.min_words)
        # Highest first: numbers are put in ascending order.
        order = scored.filter(eligible).withColumn("_below", -F.col("score"))
        numbered = number_rows(order, ["_below", "doc_id", "weight"], rn="rank", total="_n")
        drawn = F.col("rank") <= F.floor(F.col("_n") * params.percent / 100)
        columns = ["doc_id", "n_features", "weight", "score"]
        ranked = numbered.select(*columns, F.when(drawn, F.col("rank")).alias("rank"))
        rest = scored.filter(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
        return keep(ranked.union(rest), "resampling")
