"""Read and describe catalog tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """All rows of a table; naming the columns keeps the scan to them."""
    df = spark.table(table)
    return df.select(*columns) if columns else df


def query_view(spark: SparkSession, df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register `df` as a temporary view and run SQL over it."""
    df.createOrReplaceTempView(view)
    return spark.sql(sql)


def table_info(spark: SparkSession, table: str) -> dict:
    """Name and columns of a table, or its name and the error; never raises."""
    try:
        fields = spark.table(table).schema.fields
    except Exception as error:
        return {"table_name": table, "error": str(error)}
    columns = [{"name": field.name, "type": field.dataType.simpleString()} for field in fields]
    return {"table_name": table, "column_count": len(columns), "columns": columns}


def table_columns(spark: SparkSession, tables: list[str]) -> DataFrame:
    """`table_info` of several tables as rows, one per column; a failed table is one row with the error."""
    rows = []
    for table in tables:
        info = table_info(spark, table)
        if "error" in info:
            rows.append((table, None, None, None, None, info["error"]))
        else:
            for position, column in enumerate(info["columns"], start=1):
                rows.append((table, info["column_count"], position, column["name"], column["type"], None))
    return spark.createDataFrame(
        rows, "table_name string, column_count int, position int, name string, type string, error string"
    )
