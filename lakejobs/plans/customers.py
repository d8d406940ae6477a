"""Customer files to the cleaned customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.functions.cleaning import clean_email, full_name, standardize_name
from lakejobs.functions.metadata import add_processing_metadata
from lakejobs.operators.quality import quality_customers
from lakejobs.plans.job import LakeJob
from lakejobs.schemas import CUSTOMER
from lakejobs.session import stage
from lakejobs.sources.files import RESCUED, data_path, detect_format, read_first_found, read_fixture


def clean_customers(df: DataFrame) -> DataFrame:
    """Clean e-mail and names in place, then add `full_name` made of the cleaned names."""
    cleaned = df.withColumns(
        {
            "email": clean_email(F.col("email")),
            "first_name": standardize_name(F.col("first_name")),
            "last_name": standardize_name(F.col("last_name")),
        }
    )
    return cleaned.withColumn("full_name", full_name(F.col("first_name"), F.col("last_name")))


class CustomersJob(LakeJob):
    """Tab-separated files of the base path if there are any, else comma-separated ones, or one given file.

    In the local environment: `customers.dat` or else `customers.csv` in the base path. Columns are taken by
    the files' header and typed as `schemas.CUSTOMER` declares, further ones are kept as text. A `schema` of
    one's own must agree with the header; with `infer`, types are inferred, which reads all files once more.
    Files are parsed once, into the shared folder. Rows with a cell that does not fit its declared type go to the
    quarantine table, with the cell's text in the map `_rescued`; the job fails if no other rows are left.
    """

    entity = "customers"
    layer = "silver"
    required_columns = ["customer_id", "first_name", "email"]

    def __init__(
        self,
        config,
        spark=None,
        base_path: str = "",
        schema: T.StructType | str | None = None,
        scheme: str = "s3",
        infer: bool = False,
        **rest,
    ) -> None:
        super().__init__(config, spark, **rest)
        self.base_path = base_path
        self.schema = schema
        self.declared = None if infer or schema is not None else CUSTOMER
        self.scheme = scheme

    def extract(self) -> DataFrame | None:
        if self.config.env == "local":
            return self._fixture()
        if self.config.is_event_triggered:
            candidates = [(data_path(self.config, self.base_path, scheme=self.scheme), detect_format(self.config.object_key))]
        else:
            candidates = [(data_path(self.config, self.base_path, f"*.{kind}"), kind) for kind in ("dat", "csv")]
        rescued = RESCUED if self.declared is not None else None
        return self.prepare(stage(read_first_found(self.spark, candidates, self.schema, self.declared, rescued), "customers"))

    def prepare(self, staged: DataFrame) -> DataFrame:
        if RESCUED not in staged.columns:
            return staged
        stamped = add_processing_metadata(staged, self.config.job_name, self.config.job_run_id, self.run_time)
        self.rejected = stamped.filter(F.col(RESCUED).isNotNull())
        return staged.filter(F.col(RESCUED).isNull()).drop(RESCUED)

    def _fixture(self) -> DataFrame:
        try:
            return read_fixture(self.spark, self.config, self.base_path, "customers.dat")
        except FileNotFoundError:
            return read_fixture(self.spark, self.config, self.base_path, "customers.csv")

    def transform(self, df: DataFrame) -> DataFrame:
        return add_processing_metadata(
            clean_customers(df), self.config.job_name, self.config.job_run_id, self.run_time
        )

    def gate(self, df: DataFrame) -> DataFrame:
        return quality_customers(df)
