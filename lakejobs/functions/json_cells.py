"""Turn table cells into JSON values for delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_cell(text: Column) -> Column:
    """VARIANT holding the parsed JSON where the text starts like an object or array and parses, else the text.

    Unlike a plain JSON loader a VARIANT has no room for repeated keys, so such text stays text.
    """
    parsed = F.when(text.rlike(r"^[{\[]"), F.try_parse_json(text))
    return F.coalesce(parsed, text.cast("variant"))


def record_cell(df: DataFrame, name: str) -> Column:
    """The cell as it goes into a record: JSON text parsed, nested values as they are, others as text."""
    column, kind = df[name], df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return json_cell(column)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return column
    return column.cast("string")


def record_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One JSON object per row, with NULL kept as null."""
    cells = [record_cell(df, name).alias(name) for name in columns or df.columns]
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
