"""Products from API responses that lie in a table, one page per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.operators.bounded import BroadcastLimit, salted_join
from lakejobs.schemas import PRODUCT, response_schema
from lakejobs.session import stage

PAGE_SIZE = 100


def parse_response(
    responses: DataFrame, response: str = "response", item: T.StructType = PRODUCT, keep: list[str] | None = None
) -> DataFrame:
    """One row per element of each response's `data`; responses without such an array give none.

    A field that does not fit its type becomes NULL and leaves its neighbours alone.
    """
    parsed = F.from_json(responses[response], response_schema(item))
    return responses.select(*(keep or []), F.inline(parsed["data"]))


def page_length(response: Column) -> Column:
    """Number of elements in the response's `data`; 0 without one. Only the ids are decoded."""
    ids = T.StructType([PRODUCT["id"]])
    return F.coalesce(F.size(F.from_json(response, response_schema(ids))["data"]), F.lit(0))


def last_pages(
    pages: DataFrame,
    page_size: int = PAGE_SIZE,
    page: str = "page",
    response: str = "response",
    run: tuple[str, ...] = (),
) -> DataFrame:
    """The last page a client asks for, per run: the first short one, or the one before a gap.

    The pages are read once, into a narrow table of (run, page, elements) in the shared folder. A run of
    any size is reduced map-side, and the gap test joins on run *and* page, so that one large run spreads
    over all tasks.
    """
    sized = pages.filter(F.col(page) >= 1).select(
        *run, F.col(page).alias("_page"), page_length(pages[response]).alias("_n")
    )
    sized = stage(sized, "page-sizes")
    numbers = sized.select(*run, "_page")
    no_successor = numbers.withColumn("_page", F.col("_page") + 1).join(numbers, [*run, "_page"], "left_anti")
    ends = sized.select(
        *run,
        F.col("_page").alias("_first"),
        F.when(F.col("_n") < page_size, F.col("_page")).alias("_short"),
        F.lit(None).cast("bigint").alias("_gap"),
    ).unionByName(
        no_successor.select(
            *run,
            F.lit(None).cast("bigint").alias("_first"),
            F.lit(None).cast("bigint").alias("_short"),
            F.col("_page").cast("bigint").alias("_gap"),
        )
    )
    reduced = ends.groupBy(*run).agg(
        F.min("_first").alias("_first"), F.min("_short").alias("_short"), F.min("_gap").alias("_gap")
    )
    last = F.when(F.col("_first") > 1, F.lit(0)).otherwise(F.least(F.col("_short"), F.col("_gap") - 1))
    return reduced.select(*run, last.cast("bigint").alias("last_page"))


def assemble_pages(
    pages: DataFrame,
    page_size: int = PAGE_SIZE,
    page: str = "page",
    response: str = "response",
    run: tuple[str, ...] = (),
    limit: BroadcastLimit = BroadcastLimit(),
) -> DataFrame:
    """The pages a client that asks for 1, 2, 3, ... would have fetched.

    It stops after the first page shorter than `page_size`, whose rows count, and at the first page
    that is missing. With `run` columns each run is assembled on its own: the runs' last pages are sent to
    the pages while there are few runs, else the pages of huge runs are spread over many tasks.
    """
    last = last_pages(pages, page_size, page, response, run)
    if not run:
        return pages.filter((F.col(page) >= 1) & (F.col(page) <= last.scalar()))
    texts = [name for name in run if isinstance(pages.schema[name].dataType, T.StringType)]
    small = limit.local_copy(last, texts)
    joined = pages.join(F.broadcast(small), list(run)) if small is not None else salted_join(pages, last, list(run))
    return joined.filter((F.col(page) >= 1) & (F.col(page) <= F.col("last_page"))).select(*pages.columns)


def pages_from_responses(spark: SparkSession, responses: list[str]) -> DataFrame:
    """A page table from response texts held in memory, numbered from 1; for small fetches and tests."""
    return spark.createDataFrame(list(enumerate(responses, start=1)), "page bigint, response string")


def response_files(spark: SparkSession, path: str) -> DataFrame:
    """Responses kept as files, one whole document per file, pretty-printed or not."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "response")
