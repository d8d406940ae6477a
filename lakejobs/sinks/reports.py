"""Report the outcome of a run as one row of a table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from lakejobs.config import JobConfig
from lakejobs.schemas import JOB_RUN

REPORT_TABLE = "job_runs"


def run_report(
    spark: SparkSession,
    config: JobConfig,
    records: int | None = None,
    output_paths: list[str] | None = None,
    error: str | None = None,
    reported_at: datetime | None = None,
) -> DataFrame:
    """The report row: a success, or with `error` a failure."""
    row = (
        "job_failure" if error is not None else "job_success",
        config.env,
        config.job_name,
        config.job_run_id,
        config.trigger_type,
        records,
        output_paths or [],
        error,
        reported_at or datetime.now(timezone.utc),
    )
    return spark.createDataFrame([row], JOB_RUN)


def append_report(report: DataFrame, table: str = REPORT_TABLE, path: str | None = None) -> None:
    writer = report.write.mode("append")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
