"""Quality gates: every rate of a gate comes from one aggregation over the needed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The least share of good rows, and the least number of product rows.
CUSTOMER_EMAIL_RATE = 0.7
CUSTOMER_NAME_RATE = 0.9
PRODUCT_ID_RATE = 0.95
PRODUCT_NAME_RATE = 0.90
PRODUCT_MIN_ROWS = 10


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def quality_base(df: DataFrame, required: list[str]) -> DataFrame:
    """One row `(total, missing, passed)`: the table has rows and all required columns."""
    missing = ",".join(missing_columns(df, required))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"), F.lit(missing).alias("missing"), ((total > 0) & F.lit(not missing)).alias("passed")
    )


def _rates(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: `total`, and per check `valid_<name>` and `<name>_rate` (0 for an empty table)."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(good).alias(f"valid_{name}") for name, good in checks.items()],
    )
    rows = F.nullif(F.col("total"), F.lit(0))
    return counted.withColumns(
        {f"{name}_rate": F.coalesce(F.col(f"valid_{name}") / rows, F.lit(0.0)) for name in checks}
    )


def quality_customers(df: DataFrame) -> DataFrame:
    """Share of rows with an e-mail and with a first name, and whether both are high enough."""
    rates = _rates(df, {"email": F.col("email").isNotNull(), "name": F.col("first_name").isNotNull()})
    passed = (
        (F.col("total") > 0)
        & (F.col("email_rate") >= CUSTOMER_EMAIL_RATE)
        & (F.col("name_rate") >= CUSTOMER_NAME_RATE)
    )
    return rates.withColumn("passed", passed)


def quality_products(df: DataFrame) -> DataFrame:
    """Share of rows with an id, a name and a positive price; the price share does not decide."""
    price = F.col("price")
    rates = _rates(
        df,
        {
            "id": F.col("id").isNotNull(),
            "name": F.col("name").isNotNull(),
            "price": price.isNotNull() & (price > 0),
        },
    )
    passed = (
        (F.col("total") >= PRODUCT_MIN_ROWS)
        & (F.col("id_rate") >= PRODUCT_ID_RATE)
        & (F.col("name_rate") >= PRODUCT_NAME_RATE)
    )
    return rates.withColumn("passed", passed)
