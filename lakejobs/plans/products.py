"""Product pages of an API to the raw product table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.functions.categories import price_category
from lakejobs.functions.metadata import add_processing_metadata
from lakejobs.operators.quality import quality_products
from lakejobs.plans.job import LakeJob
from lakejobs.session import stage
from lakejobs.sources.api_pages import PAGE_SIZE, assemble_pages, parse_response, response_files


def enrich_products(df: DataFrame) -> DataFrame:
    """Products that have a name and a price, with price class and length of the name."""
    named = df.filter(F.col("name").isNotNull() & F.col("price").isNotNull())
    return named.withColumns(
        {"price_category": price_category(F.col("price")), "name_length": F.length(F.col("name"))}
    )


class ProductsJob(LakeJob):
    """`pages` gives the table of `(page, response)` that the API's answers were stored in.

    In the local environment `documents` may name a file or folder of whole responses instead. The
    products are written to the shared folder once they are parsed: the gate and the write then read
    columns instead of assembling and parsing the pages again.
    """

    entity = "products"
    layer = "bronze"
    required_columns = ["id", "name", "price"]
    preview_rows = 20
    preview_options = {"truncate": False, "schema": True}

    def __init__(
        self,
        config,
        spark=None,
        pages: Callable[[], DataFrame | None] | None = None,
        page_size: int = PAGE_SIZE,
        documents: str | None = None,
        **rest,
    ) -> None:
        super().__init__(config, spark, **rest)
        self.documents = documents
        self.pages = pages
        self.page_size = page_size

    def extract(self) -> DataFrame | None:
        if self.config.env == "local" and self.documents:
            return parse_response(response_files(self.spark, self.documents))
        pages = self.pages() if self.pages else None
        return None if pages is None else stage(parse_response(assemble_pages(pages, self.page_size)), "products")

    def transform(self, df: DataFrame) -> DataFrame:
        return add_processing_metadata(
            enrich_products(df), self.config.job_name, self.config.job_run_id, self.run_time
        )

    def gate(self, df: DataFrame) -> DataFrame:
        return quality_products(df)
