"""Read delimited, JSON and parquet files."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.config import JobConfig

# The formats, and the format each file extension stands for.
READERS = {
    "csv": ("csv", {"header": "true", "sep": ","}),
    "dat": ("csv", {"header": "true", "sep": "\t"}),
    "tsv": ("csv", {"header": "true", "sep": "\t"}),
    "json": ("json", {}),
    "parquet": ("parquet", {}),
}
EXTENSION_FORMATS = {
    "csv": "csv",
    "dat": "dat",
    "tsv": "dat",
    "txt": "csv",
    "json": "json",
    "parquet": "parquet",
}
DEFAULT_FORMAT = "csv"
# Column that holds the text of cells that do not fit their declared type, by column.
RESCUED = "_rescued"


def reader_options(file_format: str) -> tuple[str, dict[str, str]]:
    """Spark's source name and options for one of our formats, in any case."""
    try:
        return READERS[file_format.lower()]
    except KeyError:
        raise ValueError(f"no reader for format {file_format!r}") from None


def read_files(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = DEFAULT_FORMAT,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Read files of one format.

    Without a schema the types of delimited and JSON files are inferred, which reads the data once
    more: on large inputs give a schema, or infer from a `sampling_ratio` of the rows.
    """
    source, options = reader_options(file_format)
    reader = spark.read.format(source).options(**options)
    if schema is not None:
        # A header that differs from the schema is an error: columns are never taken by their place alone.
        reader = reader.schema(schema).option("enforceSchema", "false")
    elif source == "csv":
        reader = reader.option("inferSchema", "true")
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    if multi_line:
        reader = reader.option("multiLine", "true")
    return reader.load(path)


def typed_by_name(texts: DataFrame, declared: T.StructType, rescued: str | None = None) -> DataFrame:
    """Text columns that are declared get their type, in values that fit it; further ones stay text.

    With `rescued`, a column of that name maps each column whose text does not fit to that text; null where all fit.
    Works on streams as well.
    """
    types = {field.name: field.dataType for field in declared}
    cells = {name: F.col(f"`{name}`") for name in texts.columns}
    typed = [cell.try_cast(types[name]).alias(name) if name in types else cell for name, cell in cells.items()]
    if rescued is None:
        return texts.select(*typed)
    misfits = [
        F.when(cell.isNotNull() & cell.try_cast(types[name]).isNull(), F.struct(F.lit(name).alias("key"), cell.alias("value")))
        for name, cell in cells.items()
        if name in types and not isinstance(types[name], T.StringType)
    ]
    found = F.map_from_entries(F.array_compact(F.array(*misfits))) if misfits else F.lit(None).cast("map<string,string>")
    return texts.select(*typed, F.when(F.size(found) > 0, found).alias(rescued))


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_declared(
    spark: SparkSession, path: str | list[str], file_format: str, declared: T.StructType, rescued: str | None = None
) -> DataFrame:
    """Read delimited files by their header, without a pass for inference; types as in `typed_by_name`.

    All files must have the header of the first one. In formats that hold types nothing has to be rescued.
    """
    source, options = reader_options(file_format)
    if source != "csv":
        typed = read_files(spark, path, file_format)
        return typed.withColumn(rescued, F.lit(None).cast("map<string,string>")) if rescued else typed
    header = spark.read.format(source).options(**options).load(path).columns
    return typed_by_name(read_files(spark, path, file_format, text_schema(header)), declared, rescued)


def detect_format(object_key: str) -> str:
    """Format of one file by its extension; CSV when the extension says nothing."""
    return EXTENSION_FORMATS.get(object_key.lower().rpartition(".")[2], DEFAULT_FORMAT)


def format_of_key(object_key: Column) -> Column:
    """`detect_format` for a column of keys."""
    extension = F.element_at(F.split(F.lower(object_key), "[.]"), -1)
    known = F.create_map(*[F.lit(text) for pair in EXTENSION_FORMATS.items() for text in pair])
    return F.coalesce(F.element_at(known, extension), F.lit(DEFAULT_FORMAT))


def data_path(config: JobConfig, base_path: str, pattern: str = "*", scheme: str = "s3") -> str:
    """The one file that triggered the run, or else all files of `base_path` that fit `pattern`."""
    if config.is_event_triggered:
        return f"{scheme}://{config.bucket}/{config.object_key}"
    return f"{base_path}/{pattern}"


def read_first_found(
    spark: SparkSession,
    candidates: list[tuple[str, str]],
    schema: T.StructType | str | None = None,
    declared: T.StructType | None = None,
    rescued: str | None = None,
) -> DataFrame:
    """Read the first (path, format) that exists; any error but a missing path is raised."""
    missing: AnalysisException | None = None
    for path, file_format in candidates:
        try:
            if declared is not None:
                return read_declared(spark, path, file_format, declared, rescued)
            return read_files(spark, path, file_format, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = error
    if missing is None:
        raise ValueError("no candidate paths given")
    raise missing


def read_fixture(spark: SparkSession, config: JobConfig, directory: str, filename: str) -> DataFrame:
    """Read a development file; only the local environment may."""
    if config.env != "local":
        raise RuntimeError(f"fixtures are for the local environment, not for {config.env}")
    path = os.path.join(directory, filename)
    if not os.path.exists(path):
        raise FileNotFoundError(f"no fixture at {path}")
    return read_files(spark, path, os.path.splitext(filename)[1][1:])
