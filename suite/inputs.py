"""Job inputs made from the test tables.

The tables hold no e-mails, API answers or notifications. They are made from whole tables by SQL
expressions, and the text of each expression serves both engines, so that both start from the same
values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-15"
RUN_TIME = "2024-01-15 06:00:00"
JOB = "customer_load"
RUN_ID = "run-1"

# Customers: e-mails of every kind (the cleaning query), and mostly good ones (the job).
EMAIL_KINDS = """CASE c_custkey % 6
    WHEN 0 THEN concat('  ', upper(c_mktsegment), '.', c_custkey, '@EXAMPLE.COM ')
    WHEN 1 THEN concat(c_name, '@example.com')
    WHEN 2 THEN concat('c', c_custkey, '@invalid')
    WHEN 3 THEN ''
    WHEN 5 THEN concat('c', c_custkey, '+x@mail.example.org') END"""
EMAIL = """CASE c_custkey % 10
    WHEN 0 THEN concat(c_name, '@example.com')
    WHEN 1 THEN NULL
    WHEN 2 THEN concat(' ', upper(c_mktsegment), c_custkey, '@Example.COM  ')
    ELSE concat('c', c_custkey, '@example.org') END"""
FIRST_NAME = """CASE WHEN c_custkey % 20 = 7 THEN NULL
    WHEN c_custkey % 4 = 1 THEN concat('  ', c_mktsegment, '   &  Co ')
    ELSE c_mktsegment END"""
LAST_NAME = "CASE WHEN c_custkey % 11 = 3 THEN NULL WHEN c_custkey % 3 = 0 THEN '!!' ELSE c_name END"
# Ids in files: some beyond 32 bits, some that are no numbers.
CUSTOMER_ID = """CASE WHEN customer_id % 13 = 4 THEN concat('C', customer_id)
    WHEN customer_id % 13 = 5 THEN CAST(3000000000 + customer_id AS VARCHAR(20))
    ELSE CAST(customer_id AS VARCHAR(20)) END"""
CUSTOMER_COLUMNS = ["customer_id", "first_name", "last_name", "email", "phone"]
_DIGITS = "CAST(5550000000 + c_custkey AS VARCHAR(20))"
PHONE = f"""CASE c_custkey % 7
    WHEN 0 THEN concat(substr({_DIGITS}, 1, 3), '-', substr({_DIGITS}, 4, 3), '-', substr({_DIGITS}, 7, 4))
    WHEN 1 THEN {_DIGITS}
    WHEN 2 THEN concat('+1-', {_DIGITS})
    WHEN 3 THEN concat('(', substr({_DIGITS}, 1, 3), ')', substr({_DIGITS}, 4, 7))
    WHEN 4 THEN concat(substr({_DIGITS}, 1, 3), '.', substr({_DIGITS}, 4, 3), '.', substr({_DIGITS}, 7, 4))
    WHEN 5 THEN '' END"""

# Products: events as API items, in answers of a bounded range of ids each.
PRODUCT_NAME = "CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END"
PRODUCT_PRICE = "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END"

MISSING_PAGE = "run % 2 = 1 AND page = 2 + run % 40 OR run % 9 = 4 AND page = 1"

# Object keys from page numbers and addresses.
FORMAT_KEY = """concat('bronze/p/', page_id, CASE page_id % 8
    WHEN 0 THEN '.csv' WHEN 1 THEN '.DAT' WHEN 2 THEN '.tsv' WHEN 3 THEN '.txt'
    WHEN 4 THEN '.json' WHEN 5 THEN '.parquet' WHEN 6 THEN '.csv.gz' ELSE '' END)"""
TABLE_KEY = """CASE page_id % 3 WHEN 0 THEN concat('p', page_id)
    WHEN 1 THEN concat('silver/t', page_id % 10)
    ELSE concat('bronze/t', page_id % 7, '/part-', page_id, '.parquet') END"""
URL_KEY = "regexp_replace(url, '^[a-z]+://', '')"
FOLDER_KEY = f"""concat(CASE page_id % 6 WHEN 0 THEN 'sales/' WHEN 1 THEN 'customers/' WHEN 2 THEN 'inventory/'
    WHEN 3 THEN 'products/' WHEN 4 THEN 'Sales/' ELSE '' END, {URL_KEY})"""

# Notifications from events: every shape, and messages that yield nothing.
BUCKET = "concat('lake-', user_id % 3)"
KEY = """concat(CASE user_id % 6 WHEN 0 THEN 'sales/' WHEN 1 THEN 'customers/' WHEN 2 THEN 'inventory/'
    WHEN 3 THEN 'data/' WHEN 4 THEN 'data/special/' ELSE 'other/' END, event_type, '/', event_id, '.csv')"""
_S3 = f"""'"s3":{{"bucket":{{"name":"', b, '"}},"object":{{"key":"', k"""
# In terms of the bucket `b` and the key `k`.
MESSAGE = f"""CASE event_id % 10
    WHEN 0 THEN concat('{{"Records":[{{"eventSource":"aws:s3","eventName":"ObjectCreated:Put",', {_S3}, '"}}}}}},{{"eventSource":"aws:sqs"}}]}}')
    WHEN 1 THEN concat('{{"source":"aws.s3","detail-type":"Object Created","detail":{{"bucket":{{"name":"', b, '"}},"object":{{"key":"', k, '"}}}}}}')
    WHEN 2 THEN concat('{{"bucket":"', b, '","object_key":"', k, '","event_name":"ObjectCreated:Copy"}}')
    WHEN 3 THEN concat('{{"bucketName":"', b, '","Key":"', k, '","eventName":"Put"}}')
    WHEN 4 THEN concat('{{"invalid":"', event_type, '"}}')
    WHEN 5 THEN concat('not json ', event_type, ' {{')
    WHEN 6 THEN '{{"Records":[{{"eventSource":"aws:s3","s3":{{"bucket":{{"name":"b"}},"object":{{"key":""}}}}}}]}}'
    WHEN 7 THEN concat('{{"Bucket":"","s3Bucket":"z","key":"', k, '"}}')
    WHEN 8 THEN concat('{{"bucket":"first","bucket":"', b, '","object_key":"', k, '","detail":{{"x":1}}}}')
    ELSE concat('{{"Records":[{{"eventSource":"aws:s3",', {_S3}, '"}}}}}},{{"eventSource":"aws:s3",', {_S3}, '.bak"}}}}}}]}}') END"""
ODD_ENVELOPE = """CASE event_id % 3 WHEN 0 THEN '{"Records":[' WHEN 1 THEN '{"Records":"none"}' ELSE '{"Records":[]}' END"""
ROUTE_SPEC = "data/:bulk_load, data/special/:special_load ,no colon,inventory/:old_load,inventory/:stock_load"
CUSTOMER_SPEC = """concat('orders/', c_nationkey, ':load-', c_custkey, ' , not a route,  sales/:', c_mktsegment,
    ', sales/ :last:', c_custkey, ',:nowhere')"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("customer_id"),
        F.expr(FIRST_NAME).alias("first_name"),
        F.expr(LAST_NAME).alias("last_name"),
        F.expr(EMAIL).alias("email"),
        F.expr(PHONE).alias("phone"),
    )


def _data(*items) -> F.Column:
    return F.to_json(F.struct(F.collect_list(F.struct(*items)).alias("data")))


def part_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API answers of up to 100 parts each."""
    item = [
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("description"),
    ]
    page = F.floor(F.col("p_partkey") / 100) + 1
    return table(spark, sf_dir, "part").groupBy(page.alias("page")).agg(_data(*item).alias("response"))


def _event_item() -> list:
    return [
        F.col("event_id").alias("id"),
        F.expr(PRODUCT_NAME).alias("name"),
        F.concat(F.lit("u"), F.col("user_id")).alias("category"),
        F.expr(PRODUCT_PRICE).alias("price"),
        F.col("props").alias("description"),
    ]


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API answers of 100 events each."""
    page = F.floor(F.col("event_id") / 100) + 1
    return table(spark, sf_dir, "events").groupBy(page.alias("page")).agg(_data(*_event_item()).alias("response"))


def fetch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 50 pages; a page holds the purchases among 20 events, so pages differ in length.

    Of every other run some later page is missing, of every ninth the first one.
    """
    item = F.when(F.col("event_type") == "purchase", F.struct(*_event_item()))
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.floor(F.col("event_id") / 1000).alias("run"),
            (F.floor(F.col("event_id") % 1000 / 20) + 1).alias("page"),
        )
        .agg(F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("response"))
        .filter(f"NOT ({MISSING_PAGE})")
    )


def messages(events: DataFrame) -> DataFrame:
    placed = events.select("event_id", "event_type", F.expr(BUCKET).alias("b"), F.expr(KEY).alias("k"))
    return placed.select("event_id", F.expr(MESSAGE).alias("message"))


def envelopes(events: DataFrame) -> DataFrame:
    """Envelopes with a queue record, one behind a foreign record, two of them, or one without text.

    Of every seventh, the text is cut off, or `Records` is no list, or there are none.
    """

    def record(source: str, text) -> F.Column:
        return F.struct(F.lit(source).alias("EventSource"), F.struct(text.alias("Message")).alias("Sns"))

    message = F.col("message")
    queued, foreign = record("aws:sns", message), record("aws:ses", F.lit("x"))
    second, empty = record("aws:sns", F.concat(F.lit(" "), message)), record("aws:sns", F.lit(None).cast("string"))
    kind = F.col("event_id") % 4
    records = (
        F.when(kind == 0, F.array(queued))
        .when(kind == 1, F.array(foreign, queued))
        .when(kind == 2, F.array(queued, second))
        .otherwise(F.array(empty))
    )
    whole = F.to_json(F.struct(records.alias("Records")))
    odd = F.expr(ODD_ENVELOPE)
    return messages(events).select("event_id", F.when(F.col("event_id") % 7 == 0, odd).otherwise(whole).alias("envelope"))


def run_time() -> dt.datetime:
    return dt.datetime.fromisoformat(RUN_TIME).replace(tzinfo=dt.timezone.utc)
