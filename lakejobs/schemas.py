"""Declared schemas; passing one to a reader spares the inference pass over the data."""

from pyspark.sql import types as T

PRODUCT = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("description", T.StringType()),
    ]
)

CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
    ]
)

STATUS = "batch_number bigint, records bigint, ok boolean, error string"

JOB_RUN = (
    "event_type string, environment string, job_name string, job_run_id string, trigger_type string, "
    "records_processed bigint, output_paths array<string>, error string, reported_at timestamp"
)


def response_schema(item: T.StructType = PRODUCT) -> T.StructType:
    """The API response document: its `data` array holds the items."""
    return T.StructType([T.StructField("data", T.ArrayType(item))])
