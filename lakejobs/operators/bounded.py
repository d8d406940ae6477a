"""Joins against a smaller side: broadcast it when its measured size allows, spread the work when not."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.session import stage


@dataclass(frozen=True)
class BroadcastLimit:
    """How many rows a side may hold to be sent to every executor, and how much text each row."""

    rows: int = 10_000
    row_chars: int = 2_000

    def local_copy(self, df: DataFrame, texts: list[str]) -> DataFrame | None:
        """The rows of `df` held by the driver if they are within the limit, else None.

        Reading stops one row past the limit, and text of rows that are too long stays where it is, so
        the driver never holds more than the limit allows. Plans that use the copy do not compute `df` again.
        """
        chars = sum((F.coalesce(F.length(F.col(name)), F.lit(0)) for name in texts), F.lit(0))
        fits = chars <= self.row_chars
        guarded = [F.when(fits, F.col(name)).alias(name) if name in texts else F.col(name) for name in df.columns]
        rows = df.limit(self.rows + 1).select(*guarded, fits.alias("_fits")).toArrow()
        if rows.num_rows > self.rows or not all(rows.column("_fits").to_pylist()):
            return None
        return df.sparkSession.createDataFrame(rows.drop_columns(["_fits"]), df.schema)


def _join_key(df: DataFrame, on: list[str]) -> Column:
    """A hash of the key columns, the same for whole numbers of any width."""
    whole = [isinstance(df.schema[name].dataType, T.IntegralType) for name in on]
    return F.xxhash64(*(F.col(x).cast("bigint") if is_whole else F.col(x) for x, is_whole in zip(on, whole)))


def salted_join(
    large: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    partitions: int | None = None,
    staged: bool = False,
) -> DataFrame:
    """Equi-join (inner or left) that cuts every key of `large` with more than a partition's share of rows into parts.

    `large` is written to the shared folder first, unless the caller says that it is read from there
    (`staged`): keys are counted on the copy, and a row's part comes from its place in it, so that equal
    rows spread too and a repeated task deals them alike. No more keys than partitions can hold more than
    a fair share each. They are told by hashes, so what is broadcast does not depend on their text. Partners
    in `small` are repeated once per part, in all no more often than twice the partitions. Rows with a
    null key, which have no partner, are spread as well. The result is that of the plain join.
    """
    spark = large.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    large = large if staged else stage(large, "salted")

    key, small_key = _join_key(large, on), _join_key(small, on)
    if [large.schema[x].dataType for x in on] != [small.schema[x].dataType for x in on] and not all(
        isinstance(df.schema[x].dataType, T.IntegralType) for df in (large, small) for x in on
    ):
        raise TypeError(f"keys {on} differ in type")
    counts = large.groupBy(key.alias("_salt_key")).agg(F.count(F.lit(1)).alias("_salt_rows"))
    total = counts.agg(F.sum("_salt_rows")).scalar()
    parts = F.ceil(F.col("_salt_rows") * partitions / F.lit(total)).cast("bigint").alias("_salt_parts")
    fair = F.col("_salt_rows") * partitions > F.lit(total)
    hottest = counts.filter(fair).select("_salt_key", parts).toArrow()
    hot = F.broadcast(spark.createDataFrame(hottest, "_salt_key bigint, _salt_parts bigint"))

    no_key = reduce(or_, [F.col(name).isNull() for name in on])
    parts = F.when(no_key, F.lit(partitions)).otherwise(F.coalesce("_salt_parts", F.lit(1)))
    placed = large.withColumn("_salt_place", F.monotonically_increasing_id()).withColumn("_salt_key", key)
    salted = placed.join(hot, "_salt_key", "left").withColumn("_salt", F.pmod("_salt_place", parts)).drop("_salt_parts", "_salt_place", "_salt_key")
    all_parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salt_parts", F.lit(1)) - 1)
    repeated = small.withColumn("_salt_key", small_key).join(hot, "_salt_key", "left").withColumn("_salt", F.explode(all_parts))
    return salted.join(repeated.drop("_salt_parts", "_salt_key"), [*on, "_salt"], how).drop("_salt")
