"""Deliveries that can be resumed: a ledger of acknowledged batches."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.operators.batching import PAYLOAD_BYTES, Retry, outcomes, to_deliver
from lakejobs.schemas import STATUS
from lakejobs.session import arrow_batches, stage

LEDGER = "batch_number bigint, payload_hash string, records bigint"


class _Ledger:
    """Writes one small file per acknowledged batch, which stands as soon as `add` returns."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.system, self.folder = fs.FileSystem.from_uri(folder)
        self.system.create_dir(self.folder, recursive=True)

    def add(self, batch: int, payload_hash: str, records: int) -> None:
        line = json.dumps({"batch_number": batch, "payload_hash": payload_hash, "records": records})
        with self.system.open_output_stream(f"{self.folder}/{batch}-{uuid.uuid4().hex}.json") as out:
            out.write(line.encode())


def _folders(ledger: str, export_id: str) -> tuple[str, str]:
    """Of an export: where its batches are acknowledged one by one, and where earlier runs' are kept together."""
    return f"{ledger}/open/{export_id}", f"{ledger}/closed/{export_id}"


def acknowledged(spark: SparkSession, ledger: str, export_id: str) -> DataFrame:
    """(batch_number, payload_hash, records) of the batches an export has delivered so far."""
    found = spark.createDataFrame([], LEDGER)
    for folder, source in zip(_folders(ledger, export_id), ("json", "parquet"), strict=True):
        try:
            found = found.union(spark.read.schema(LEDGER).format(source).load(folder))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found.dropDuplicates(["batch_number", "payload_hash"])


def close_ledger(spark: SparkSession, ledger: str, export_id: str) -> None:
    """Keep an export's acknowledgements in one table instead of a file each; for when none of its runs is going on."""
    open_folder, closed = _folders(ledger, export_id)
    stage(acknowledged(spark, ledger, export_id), "ledger").write.mode("overwrite").parquet(closed)
    path = spark._jvm.org.apache.hadoop.fs.Path(open_folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def deliver_resumable(
    payloads: DataFrame, send: Callable[[str], object], ledger: str, export_id: str, retry: Retry = Retry()
) -> DataFrame:
    """Deliver the batches that no run of the same export has delivered; `(batch_number, records, ok, error, resumed)`.

    A batch counts as delivered if its number and its payload's hash stand in the ledger, a folder that all executors
    reach. A task enters each batch as soon as `send` has returned, so whatever ends a run, only the batches being
    sent at that moment may be sent again. A batch whose rows have changed has another hash and is sent. Batches of earlier
    runs come out as `resumed`. Failed ones are tried as `retry` says, and again by the next run.
    """
    spark = payloads.sparkSession
    folder = _folders(ledger, export_id)[0]
    hashed = payloads.select("batch_number", "records", "payload", F.sha2("payload", 256).alias("payload_hash"))
    # What was known before this run, whatever it adds to the ledger.
    before = stage(acknowledged(spark, ledger, export_id), "acknowledged")
    pending = hashed.join(before, ["batch_number", "payload_hash"], "left_anti")

    def attempt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _Ledger(folder)

        def deliver(row: dict) -> str | None:
            error = retry.call(send, row["payload"])
            if error is None:
                entries.add(row["batch_number"], row["payload_hash"], row["records"])
            return error

        return outcomes(batches, deliver)

    with arrow_batches(spark, PAYLOAD_BYTES):
        sent = stage(to_deliver(pending, "payload_hash").mapInArrow(attempt, STATUS), "delivery").withColumn("resumed", F.lit(False))
    numbers = hashed.select("batch_number", "records", "payload_hash")
    known = numbers.join(before.select("batch_number", "payload_hash"), ["batch_number", "payload_hash"], "left_semi")
    old = known.select("batch_number", "records", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"), F.lit(True).alias("resumed"))
    return sent.union(old)
