"""Take in files that have not been taken in before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakejobs.plans.job import LakeJob
from lakejobs.schemas import CUSTOMER
from lakejobs.sources.files import RESCUED, reader_options, text_schema, typed_by_name


def stream_files(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    file_format: str = "parquet",
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Streaming source over a directory; `max_files` bounds what one micro-batch reads."""
    source, options = reader_options(file_format)
    reader = spark.readStream.format(source).options(**options).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if source == "csv":
        # Columns are never taken by their place alone.
        reader = reader.option("enforceSchema", "false")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(directory)


def finish(query: StreamingQuery, timeout: int) -> None:
    """Wait for a query that ends by itself; stop it and raise when it takes longer."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query still running after {timeout} s")


def ingest_new_files(stream: DataFrame, sink: str, checkpoint: str, timeout: int = 3600) -> None:
    """Append the rows of all new files to parquet in `sink`, exactly once, then end.

    The checkpoint remembers what was read. Another run with the same checkpoint adds only files
    that have come since.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout)


def stream_declared(
    spark: SparkSession,
    directory: str,
    file_format: str = "csv",
    declared: T.StructType = CUSTOMER,
    header: list[str] | None = None,
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Streaming source over delimited files with this header (the declared columns if not given), types by name.

    The text of cells that do not fit is in `_rescued`.
    """
    schema = text_schema(header or declared.names)
    return typed_by_name(stream_files(spark, directory, schema, file_format, pattern, max_files), declared, RESCUED)


def run_on_new_files(job: LakeJob, stream: DataFrame, sink: str, checkpoint: str, timeout: int = 3600) -> None:
    """Take the files that have come since the last run through the job, a micro-batch at a time, then end.

    Each micro-batch passes the job's transform and gate and replaces its own folder of `sink`, `batch_id=<number>`,
    so one that is repeated leaves its rows once. What the gate turns down raises and is not taken as done: the next run
    starts with the same files.
    """

    def process(rows: DataFrame, batch_id: int) -> None:
        job.run_batch(rows, f"{sink}/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout)
