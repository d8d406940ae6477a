"""Stamp rows with the run that made them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_processing_metadata(
    df: DataFrame, job_name: str, job_run_id: str, run_time: datetime | Column | None = None
) -> DataFrame:
    """Append `processed_timestamp`, `processed_by_job`, `job_run_id`.

    `current_timestamp()` differs between plans derived from one DataFrame. A job therefore passes
    its `run_time`, so that the rows it validates and the rows it writes carry the same stamp.
    """
    if run_time is None:
        stamp = F.current_timestamp()
    elif isinstance(run_time, Column):
        stamp = run_time
    else:
        stamp = F.lit(run_time)
    return df.withColumns(
        {"processed_timestamp": stamp, "processed_by_job": F.lit(job_name), "job_run_id": F.lit(job_run_id)}
    )
