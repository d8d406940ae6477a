"""Write whole tables, name them, and preview what would be written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakejobs.config import DEFAULT_TABLE

DEFAULT_TABLE_FORMAT = "parquet"
# Formats that Spark keeps as plain files.
_FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")


def table_name(env: str, entity: str, layer: str) -> str:
    return f"{env}_{entity}_{layer}"


def table_for_key(object_key: str, env: str = "dev") -> str:
    """Table behind a key like `silver/customers/part.parquet`; a fixed one for keys without folders."""
    layer, *rest = object_key.split("/")
    return table_name(env, rest[0], layer) if rest else DEFAULT_TABLE


def table_of_key(object_key: Column, env: str = "dev") -> Column:
    """`table_for_key` for a column of keys."""
    parts = F.split(object_key, "/")
    named = F.concat_ws("_", F.lit(env), F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))
    return F.when(F.size(parts) >= 2, named).otherwise(F.lit(DEFAULT_TABLE))


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    table_format: str = DEFAULT_TABLE_FORMAT,
    partition_by: list[str] | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Save `df` as a catalog table and return how many rows went in, counted while writing.

    `options` go to the format's writer, such as a compression.
    """
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(table_format).mode(mode).options(**options or {})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return written.get["rows"]


def overwrite_partitions(df: DataFrame, table: str, options: dict[str, str] | None = None) -> int:
    """Replace those partitions of a partitioned table that `df` has rows of, and return how many rows went in.

    The other partitions stay as they are, files and all. Columns go by name. Tables whose catalog plans writes by
    itself get the rows through it; file tables through a dynamic overwrite that is bound to this write.
    """
    spark = df.sparkSession
    described = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "# Partition Information" not in described and "# Partitioning" not in described:
        raise ValueError(f"{table} has no partitions")
    columns = spark.table(table).columns
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"columns of {table} are {columns}, not {df.columns}")
    written = Observation()
    counted = df.select(*columns).observe(written, F.count(F.lit(1)).alias("rows"))
    if described.get("Provider", "").lower() not in _FILE_FORMATS:
        counted.writeTo(table).options(**options or {}).overwritePartitions()
        return written.get["rows"]
    partitioned = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    writer = counted.write.format(described["Provider"]).partitionBy(*partitioned).mode("overwrite")
    writer.options(**options or {}).option("partitionOverwriteMode", "dynamic").save(described["Location"])
    # The catalog learns of partitions that are new.
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return written.get["rows"]


def preview(df: DataFrame, rows: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """The first rows, in a stable order if one is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def show_preview(df: DataFrame, rows: int = 10, truncate: bool = True, schema: bool = False) -> None:
    df.show(rows, truncate=truncate)
    if schema:
        df.printSchema()
