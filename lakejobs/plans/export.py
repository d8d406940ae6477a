"""Deliver rows of a lake table in batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.config import ExportRequest
from lakejobs.operators.batching import deliver_batches, delivery_summary, ordered_payloads
from lakejobs.operators.selection import matching, on_dates, row_cap
from lakejobs.session import scratch
from lakejobs.sources.catalog import read_table


def wanted_rows(df: DataFrame, request: ExportRequest, date_column: str = "processed_timestamp") -> DataFrame:
    """Date filter, then predicate; the cap comes with the numbering."""
    return matching(on_dates(df, request.date_filter, request.as_of, date_column), request.where)


def export_rows(
    df: DataFrame,
    request: ExportRequest,
    send: Callable[[str], object],
    order_by: list[str],
    date_column: str = "processed_timestamp",
) -> DataFrame:
    """Deliver the wanted rows, or the first ones up to a cap that the request sets; the summary as one row.

    Besides the counts of the delivery it holds how many rows were selected, how many of them were
    delivered, and whether a cap left some out. All numbers are zero when there are no rows.
    """
    wanted, cap = wanted_rows(df, request, date_column), row_cap(request.limit, request.max_records)
    status = deliver_batches(ordered_payloads(wanted, order_by, request.batch_size, cap), send)
    delivered = status.agg(F.coalesce(F.sum(F.when(F.col("ok"), F.col("records"))), F.lit(0)).alias("delivered_records"))
    summary = delivery_summary(status, request.batch_size).join(F.broadcast(delivered))
    selected = F.col("total_records") if cap is None else F.lit(wanted.count())
    return summary.withColumn("selected_records", selected).withColumn(
        "truncated", F.col("selected_records") > F.col("total_records")
    )


def export_table(
    spark: SparkSession,
    request: ExportRequest,
    send: Callable[[str], object],
    order_by: list[str],
    columns: list[str] | None = None,
    date_column: str = "processed_timestamp",
) -> dict:
    """Run one export; `{"status": "no_data"}` when nothing was selected, else `delivered` with the summary."""
    rows = read_table(spark, request.table, columns)
    with scratch(spark):
        result = export_rows(rows, request, send, order_by, date_column).first().asDict()
    if result["total_records"] == 0:
        return {"status": "no_data", "total_records": 0}
    return {"status": "delivered", **result}
