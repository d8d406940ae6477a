"""Number rows, cut them into batches, deliver the batches and sum up the outcome."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakejobs.config import BATCH_SIZE
from lakejobs.functions.json_cells import record_json
from lakejobs.functions.ranges import upper_place
from lakejobs.schemas import STATUS
from lakejobs.session import arrow_batches, stage

# monotonically_increasing_id() holds the partition above these bits and the row's place below them.
_PLACE_BITS = 33
# So many rows may be sorted by one task.
_FEW = 100_000
# Bytes of payloads that a sending task holds, or one payload.
PAYLOAD_BYTES = 4 << 20


# So many sampled rows are expected below a limit, and so many deviations above that number lies the bound.
_SAMPLED, _DEVIATIONS = 128, 4


def _tuple(columns: list[str]) -> Column:
    """The sort columns as one value; it compares as rows sort: column by column, nulls first."""
    return F.struct(*columns)


def _up_to(df: DataFrame, order_by: list[str], last: Row) -> Column:
    """Whether a row sorts no later than `last`; a plain bound on the leading column goes ahead of it, for the scan."""
    bounds = [F.lit(last[name]).cast(df.schema[name].dataType).alias(name) for name in order_by]
    leading = F.col(order_by[0])
    below = leading.isNull() if last[order_by[0]] is None else leading.isNull() | (leading <= bounds[0])
    return below & (_tuple(order_by) <= F.struct(*bounds)) if len(order_by) > 1 else below


def _cut(df: DataFrame, order_by: list[str], limit: int) -> tuple[DataFrame, int | None]:
    """`first_rows_cut`, and how many rows it keeps; None if nothing could be cut off."""
    keys = df.select(*order_by)
    share = min(1.0, _SAMPLED / limit)
    wanted = limit if share == 1.0 else math.ceil(_SAMPLED + _DEVIATIONS * math.sqrt(_SAMPLED))
    first = keys.sample(share, seed=0) if share < 1.0 else keys
    rows = first.orderBy(*order_by).limit(wanted).collect()
    # A NaN is no bound that files' statistics know.
    if len(rows) < wanted or any(isinstance(x, float) and math.isnan(x) for x in rows[-1]):
        return df, None
    kept = df.filter(_up_to(df, order_by, rows[-1]))
    count = kept.count()
    return (kept, count) if count >= limit else (df, None)


def first_rows_cut(df: DataFrame, order_by: list[str], limit: int) -> DataFrame:
    """A subset of `df` that holds its first `limit` rows in the given order, found from the sort columns alone.

    The bound is one row's whole sort tuple, so rows that share a leading value, or a stem of its text, are
    still told apart. It is taken from a sample that holds some 128 of the wanted rows, whatever the limit and the
    size of the table; tasks hand on no more than the sample's first rows. A count confirms that enough rows lie
    below it; should they not, nothing is cut off. A filter on the leading column reaches the scan.
    """
    return _cut(df, order_by, limit)[0]


def first_rows(df: DataFrame, order_by: list[str], limit: int) -> DataFrame:
    """The first `limit` rows. Few that are left by the cut are sorted as they are, more are numbered by ranges."""
    kept, count = _cut(df, order_by, limit)
    if count is not None and count <= _FEW:
        return kept.orderBy(*order_by).limit(limit)
    return number_rows(kept, order_by, limit, cut=False).select(*df.columns)


def number_rows(
    df: DataFrame,
    order_by: list[str],
    limit: int | None = None,
    partitions: int | None = None,
    rn: str = "rn",
    total: str = "total",
    cut: bool = True,
) -> DataFrame:
    """Add the row's number from 1 in the given order, and the number of all rows.

    `order_by` should end in a unique column. The rows are range-partitioned and sorted, written once to
    the shared folder, and numbered from the sizes of the partitions before their own: one shuffle, and no
    task sees more than its range. Equal leading sort values do not pile up, as the ranges split on all
    columns. With a `limit` only the first rows come out; what cannot be among them is cut off by a filter
    before anything is shuffled, unless `cut` says that this has been done.
    """
    if limit is not None and cut:
        df = first_rows_cut(df, order_by, limit)
    split = [partitions, *order_by] if partitions else order_by
    ranges = df.repartitionByRange(*split).sortWithinPartitions(*order_by)
    placed = stage(ranges.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", _PLACE_BITS)
    # One row per partition of the shuffle, whatever the size of the data.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias(total),
    )
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_before") + place + 1).alias(rn), total)
    )
    if limit is None:
        return numbered
    return numbered.filter(F.col(rn) <= limit).withColumn(total, F.least(F.col(total), F.lit(limit)))


def batch_records(
    df: DataFrame,
    order_by: list[str],
    batch_size: int = BATCH_SIZE,
    limit: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add `rn`, `batch_number` (from 1) and `total_batches` to the rows, or to the first `limit` of them."""
    numbered = number_rows(df, order_by, limit, partitions, "rn", "_total")
    return numbered.withColumns(
        {
            "batch_number": F.floor((F.col("rn") - 1) / batch_size) + 1,
            "total_batches": F.ceil(F.col("_total") / batch_size),
        }
    ).drop("_total")


def _payload(number: Column, total: Column, records: Column) -> Column:
    """A batch's JSON, from its records' places and texts."""
    texts = F.array_join(F.sort_array(records)["text"], ",")
    parts = [F.lit('{"batch_number":'), number.cast("string"), F.lit(',"total_batches":'), total.cast("string")]
    return F.concat(*parts, F.lit(',"records":['), texts, F.lit("]}"))


def batch_payloads(
    batched: DataFrame, columns: list[str] | None = None, record: Column | None = None
) -> DataFrame:
    """One row per batch: `batch_number`, `total_batches`, `records` (how many) and the JSON `payload`.

    Records are put into JSON before they are grouped, so the shuffle moves compact text, and a
    group never holds more than one batch. See `ordered_payloads` for rows that are not numbered yet.
    """
    body = [name for name in batched.columns if name not in ("rn", "batch_number", "total_batches")]
    text = record if record is not None else record_json(batched, columns or body)
    rows = batched.select("batch_number", "total_batches", F.struct("rn", text.alias("text")).alias("_record"))
    grouped = rows.groupBy("batch_number", "total_batches").agg(
        F.count(F.lit(1)).alias("records"), F.collect_list("_record").alias("_records")
    )
    payload = _payload(F.col("batch_number"), F.col("total_batches"), F.col("_records"))
    return grouped.select("batch_number", "total_batches", "records", payload.alias("payload"))


def ordered_payloads(
    df: DataFrame,
    order_by: list[str],
    batch_size: int = BATCH_SIZE,
    limit: int | None = None,
    partitions: int | None = None,
    columns: list[str] | None = None,
    record: Column | None = None,
) -> DataFrame:
    """`batch_payloads` of `batch_records`, with the records' text in one shuffle and no copy of it.

    The sort columns alone are numbered first. That gives ranges of whole batches, by the sort tuples of their first
    rows, one per range; each record finds its range among them by halving. As a range holds whole batches, the
    shuffle that brings it together also brings its batches together, and a record's place there gives its batch.
    Should a range begin between rows whose sort tuples are equal, the rows themselves are numbered.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One row past the limit tells whether the limit falls between equal rows.
    numbered = number_rows(df.select(*order_by), order_by, limit and limit + 1, partitions, "_rn", "_total")
    found = numbered.select("_total").first()
    if found is None:
        return batch_payloads(batch_records(df.limit(0), order_by, batch_size), columns, record)
    total = min(found[0], limit or found[0])
    batches = -(-total // batch_size)
    step = -(-batches // parts) * batch_size
    number = F.col("_rn")
    starts = (number <= total) & ((number - 1) % step == 0)
    edges = starts | (number % step == 0) | (number >= total)
    # At most two rows per range.
    around = Window.orderBy("_rn")
    tied = (F.lag("_rn").over(around) == number - 1) & F.lag("_key").over(around).eqNullSafe(F.col("_key"))
    begins = (starts | (number > total)) & tied
    borders = numbered.filter(edges).select("_rn", _tuple(order_by).alias("_key"))
    borders = stage(borders.select("_rn", "_key", F.coalesce(begins, F.lit(False)).alias("_tied")), "borders")
    if not borders.filter("_tied").isEmpty():
        return batch_payloads(batch_records(df, order_by, batch_size, limit, partitions), columns, record)

    if limit is not None and found[0] > total:
        df = df.filter(_up_to(df, order_by, borders.filter(number == total).select("_key.*").first()))
    ranges = borders.filter(starts & (number > 1)).agg(F.array_sort(F.collect_list("_key")))
    text = record if record is not None else record_json(df, columns or df.columns)
    by = [F.col(name).alias(f"_by{i}") for i, name in enumerate(order_by)]
    records = df.select(*by, text.alias("_text"), _tuple(order_by).alias("_key"), ranges.scalar().alias("_ranges"))
    part = upper_place(F.col("_key"), F.col("_ranges"), -(-total // step) - 1)
    split = [partitions, "_part"] if partitions else ["_part"]
    moved = records.withColumn("_part", part).drop("_key", "_ranges").repartition(*split)
    # All ranges but the last hold `step` rows, so their sum tells nothing of a row's place in its own.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) % step
    placed = moved.sortWithinPartitions("_part", *[f"_by{i}" for i in range(len(by))]).withColumn("_place", place)
    batch = F.col("_part").cast("bigint") * (step // batch_size) + F.floor(F.col("_place") / batch_size) + 1
    grouped = (
        placed.select("_part", batch.alias("batch_number"), F.struct("_place", F.col("_text").alias("text")).alias("_record"))
        .groupBy("_part", "batch_number")
        .agg(F.count(F.lit(1)).alias("records"), F.collect_list("_record").alias("_records"))
        .withColumn("total_batches", F.lit(batches).cast("bigint"))
    )
    payload = _payload(F.col("batch_number"), F.col("total_batches"), F.col("_records"))
    return grouped.select("batch_number", "total_batches", "records", payload.alias("payload"))


@dataclass(frozen=True)
class Retry:
    """A batch is sent up to `attempts` times; waits between them, in seconds, grow by `factor` from `wait` to `longest`."""

    attempts: int = 3
    wait: float = 1.0
    factor: float = 2.0
    longest: float = 30.0

    def call(self, send: Callable[[str], object], payload: str) -> str | None:
        """Send, and again while that fails; the last error's text, or None."""
        for attempt in range(self.attempts):
            try:
                send(payload)
                return None
            except Exception as error:
                text = str(error) or type(error).__name__
            if attempt + 1 < self.attempts:
                time.sleep(min(self.longest, self.wait * self.factor**attempt))
        return text


ONCE = Retry(attempts=1)


def deliver_batches(payloads: DataFrame, send: Callable[[str], object], retry: Retry = ONCE) -> DataFrame:
    """Call `send(payload)` for every batch on the executors; rows `(batch_number, records, ok, error)`.

    An exception marks its batch as failed, after the attempts that `retry` allows, and the others go on. The status
    rows are written once and read back, so that using them does not send again. A task that Spark repeats does send
    its batches again: receivers should drop a `batch_number` they have seen, or see `deliver_resumable`.
    """

    def attempt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return outcomes(batches, lambda row: retry.call(send, row["payload"]))

    with arrow_batches(payloads.sparkSession, PAYLOAD_BYTES):
        return stage(to_deliver(payloads).mapInArrow(attempt, STATUS), "delivery")


def to_deliver(payloads: DataFrame, *more: str) -> DataFrame:
    """The columns of payloads that a delivery needs, with the types of its status rows."""
    numbers = [F.col(name).cast("bigint").alias(name) for name in ("batch_number", "records")]
    return payloads.select(*numbers, "payload", *more)


def outcomes(batches: Iterator[pa.RecordBatch], deliver: Callable[[dict], str | None]) -> Iterator[pa.RecordBatch]:
    """Status rows of what `deliver` returns for each row, an error's text or None; one row at a time is made Python's."""
    for batch in batches:
        errors = [deliver(batch.slice(i, 1).to_pylist()[0]) for i in range(batch.num_rows)]
        ok = pa.array([error is None for error in errors], pa.bool_())
        columns = [batch.column("batch_number"), batch.column("records"), ok, pa.array(errors, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["batch_number", "records", "ok", "error"])


def delivery_summary(status: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """One row: records, batches, successes, failures and the share of successes (0 without batches)."""
    counts = status.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.count_if(F.col("ok")).alias("successful_batches"),
        F.count_if(~F.col("ok")).alias("failed_batches"),
    )
    attempted = F.greatest(F.col("successful_batches") + F.col("failed_batches"), F.lit(1))
    return counts.select(
        "total_records",
        F.ceil(F.col("total_records") / batch_size).alias("total_batches"),
        "successful_batches",
        "failed_batches",
        (F.col("successful_batches") / attempted).alias("success_rate"),
    )
