"""Pack token sequences: concatenate all documents, cut every `length` ids.

Documents are tokenized once, in their own tasks; ids go to the shared folder with their place within
the task's run of ids. Sums of the tasks' totals (one row per task) say where each run starts in the
whole, so each document's place is known without another pass over the ids. A document that crosses
borders of sequences gives one piece for each sequence it reaches. Only the last sequence is not full.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakejobs.llm.shared import chunks, keep, text_bytes
from lakejobs.session import scratch, stage

LENGTH = 2048
END = 1
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
# Lead bytes up to this belong to scripts (U+0000 to U+04FF) for which both libraries know the same letters.
_COMMON_LEAD = 0xD3


@cache
def _coders(tokenizer: str, ranks: str | None):
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer)
    if ranks is None:
        return whole, None
    with open(ranks, "rb") as lines:
        pairs = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {x.content: i for i, x in whole.get_added_tokens_decoder().items()}
    quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs, special_tokens=special)
    return whole, quick


def token_ids(texts: pa.Array, tokenizer: str, ranks: str | None, end: int = END) -> Iterator[np.ndarray]:
    """Each text's ids and the end id.

    With `ranks`, the same vocabulary in the form of the quicker library, texts in common scripts are
    coded by that one; its ids are the same.
    """
    whole, quick = _coders(tokenizer, ranks)
    data, offsets = text_bytes(texts)
    rare = np.concatenate([[0], np.cumsum(data > _COMMON_LEAD)])
    rare = np.diff(rare[offsets]) > 0
    for text, other in zip(texts.to_pylist(), rare.tolist(), strict=True):
        if other or quick is None:
            ids = np.array(whole.encode(text or "", add_special_tokens=False).ids, np.uint32)
        else:
            ids = quick.encode_to_numpy(text or "", allowed_special="all")
        yield np.append(ids, np.uint32(end))


def tokenize(docs: DataFrame, tokenizer: str, ranks: str | None) -> DataFrame:
    """(doc_id, run, at, ids): the task's number, the ids before the document in its task, and ids as uint32 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in chunks(batch, "text"):
                ids = list(token_ids(part.column("text"), tokenizer, ranks))
                ends = at + np.cumsum([len(x) for x in ids])
                starts = np.concatenate([[at], ends[:-1]])
                at = int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(np.full(len(ids), task), pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                    ],
                    ["doc_id", "run", "at", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, run int, at long, ids binary")


def run_starts(tokens: DataFrame) -> DataFrame:
    """(run, base): ids in all runs before; one row per task that tokenized."""
    totals = tokens.groupBy("run").agg(F.sum(F.length("ids") / 4).cast("long").alias("total"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("run", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def _pieces(placed: DataFrame, length: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        for batch in batches:
            places = batch.column("place").to_pylist()
            rows: list[tuple] = []
            for doc, place, ids in zip(batch.column("doc_id").to_pylist(), places, batch.column("ids"), strict=True):
                body = memoryview(ids.as_buffer())
                total, at = len(body) // 4, 0
                while at < total:
                    sequence, offset = divmod(place + at, length)
                    size = min(length - offset, total - at)
                    piece = bytes(body[4 * at : 4 * (at + size)])
                    rows.append((doc, at, size, zlib.crc32(piece), total, sequence, offset, piece))
                    at += size
            kinds = [pa.int64()] * 7 + [pa.binary()]
            columns = zip(*rows, strict=True) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return placed.mapInArrow(cut, schema)


def pack(
    docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None, length: int = LENGTH, with_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    `docs` needs `doc_id` and `text`; other columns are ignored. A null or empty text has the end id
    alone. Repeated rows are packed each; a null `doc_id` stays null. Pieces of a sequence are gapless
    from 0; `ids` holds them as little-endian unsigned 32-bit integers. Which document stands where
    follows the order of the input's partitions. An empty table gives no pieces. By default both files
    come from the installed vocabulary folder; with a `tokenizer` of one's own, `ranks` may stay out.
    """
    if tokenizer is None:
        tokenizer, ranks = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)
    spark = docs.sparkSession
    with scratch(spark):
        tokens = stage(tokenize(docs, tokenizer, ranks), "packing-ids")
        bases = stage(run_starts(tokens), "packing-runs")
        # One row per task, whatever the size of the documents.
        placed = tokens.join(F.broadcast(bases), "run").select("doc_id", (F.col("base") + F.col("at")).alias("place"), "ids")
        pieces = _pieces(placed, length)
        return keep(pieces if with_ids else pieces.drop("ids"), "packing")
