"""Pick the rows to export: by date, by a predicate, up to a cap."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.batching import first_rows


def on_dates(
    df: DataFrame, date_filter: str | None, as_of: date | str | None = None, column: str = "processed_timestamp"
) -> DataFrame:
    """Rows of `today`, `yesterday` or `last_week`, as seen from `as_of` (default: the current date).

    `last_week` starts seven days back and has no end. Any other name keeps all rows. The filter is a
    range on the bare column, so it reaches the scan and prunes files and partitions.
    """
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    moment = F.col(column)
    ranges = {
        "today": (moment >= day) & (moment < F.date_add(day, 1)),
        "yesterday": (moment >= F.date_sub(day, 1)) & (moment < day),
        "last_week": moment >= F.date_sub(day, 7),
    }
    return df.filter(ranges[date_filter]) if date_filter in ranges else df


def matching(df: DataFrame, where: str | None) -> DataFrame:
    """Rows that fit a SQL predicate.

    The text binds as one condition beside earlier filters, also when it contains OR. It is run as
    SQL: take it from trusted callers only.
    """
    return df.filter(F.expr(where)) if where else df


def row_cap(limit: int | None, max_records: int | None = None) -> int | None:
    """The smaller of both; None when neither is set. A limit of 0 counts as not set."""
    if (limit or 0) < 0 or (max_records or 0) < 0:
        raise ValueError(f"limits must not be negative: {limit}, {max_records}")
    return min((x for x in (limit or None, max_records) if x is not None), default=None)


def capped(df: DataFrame, order_by: list[str], limit: int | None, max_records: int | None = None) -> DataFrame:
    """The first rows in the given order, or all rows without a cap; see `first_rows`."""
    cap = row_cap(limit, max_records)
    return df if cap is None else first_rows(df, order_by, cap)
