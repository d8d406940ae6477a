"""What the operators share: reading tables, results that outlive their work, and chunks of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakejobs.session import fresh_path

CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back; unlike `stage`, it outlives a `scratch` block."""
    path = fresh_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and where each text starts (with the end as last); null is empty."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[starts[0] : starts[-1]], starts - starts[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold at most `limit` bytes, or one text."""
    starts = text_bytes(batch.column(column))[1]
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end
