"""Quality gates, sinks and whole jobs."""

import datetime as dt
import json
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakejobs.__main__ import main
from lakejobs.config import JobConfig
from lakejobs.operators.quality import quality_base, quality_customers, quality_products
from lakejobs.plans.customers import CustomersJob, clean_customers
from lakejobs.plans.job import LakeJob
from lakejobs.plans.products import ProductsJob, enrich_products
from lakejobs.sinks.reports import append_report, run_report
from lakejobs.sinks.tables import overwrite_partitions, preview, show_preview, table_for_key, table_name, table_of_key, write_table
from lakejobs.sources.api_pages import pages_from_responses

CUSTOMER = "customer_id int, first_name string, last_name string, email string, phone string"
PRODUCT = "id int, name string, category string, price decimal(10,2), description string"
GOOD = [(i, f"First{i}", f"Last{i}", f"c{i}@example.com", None) for i in range(1, 11)]


def unique(name):
    return f"{name}_{uuid.uuid4().hex}"


def customers(spark, bad_emails=0, bad_names=0):
    rows = [
        (i, None if i <= bad_names else f, last, None if i <= bad_emails else e, p) for i, f, last, e, p in GOOD
    ]
    return spark.createDataFrame(rows, CUSTOMER)


# Quality


@pytest.mark.parametrize("emails, names, passed", [(0, 0, True), (3, 1, True), (4, 0, False), (0, 2, False)])
def test_customer_gate_passes_at_the_bounds(spark, emails, names, passed):
    row = quality_customers(customers(spark, emails, names)).first()
    assert (row["total"], row["valid_email"], row["valid_name"]) == (10, 10 - emails, 10 - names)
    assert (row["email_rate"], row["name_rate"], row["passed"]) == ((10 - emails) / 10, (10 - names) / 10, passed)


def test_gates_of_empty_tables_fail_without_dividing(spark):
    empty = spark.createDataFrame([], CUSTOMER)
    row = quality_customers(empty).first()
    assert (row["total"], row["email_rate"], row["passed"]) == (0, 0.0, False)
    assert not quality_base(empty, ["email"]).first()["passed"]
    assert not quality_products(spark.createDataFrame([], PRODUCT)).first()["passed"]


def test_base_gate(spark):
    df = customers(spark)
    assert quality_base(df, ["email"]).first().asDict() == {"total": 10, "missing": "", "passed": True}
    row = quality_base(df, ["email", "zip", "age"]).first()
    assert (row["missing"], row["passed"]) == ("age,zip", False)


def products(spark, n, no_id=0, no_name=0, no_price=0):
    rows = [
        (None if i < no_id else i, None if i < no_name else f"p{i}", "c", None if i < no_price else Decimal(i), None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, PRODUCT)


@pytest.mark.parametrize(
    "counts, passed",
    [((10,), True), ((9,), False), ((5,), False), ((20, 1), True), ((20, 2), False), ((20, 0, 2), True), ((15, 0, 5), False), ((20, 0, 0, 20), True)],
)
def test_product_gate_ignores_prices(spark, counts, passed):
    row = quality_products(products(spark, *counts)).first()
    assert row["passed"] is passed
    if len(counts) == 4:
        assert row["price_rate"] == 0.0
    elif len(counts) == 1:
        assert row["valid_price"] == counts[0] - 1  # a price of zero is not positive


# Sinks


def test_table_names(spark):
    assert table_name("prod", "customers", "silver") == "prod_customers_silver"
    cases = {
        "silver/customers/data.parquet": "dev_customers_silver",
        "bronze/products/raw.json": "dev_products_bronze",
        "gold/orders/aggregated.parquet": "dev_orders_gold",
        "silver/x": "dev_x_silver",
        "silver/": "dev__silver",
        "invalid": "dev_customers_silver",
        "": "dev_customers_silver",
    }
    assert {key: table_for_key(key) for key in cases} == cases
    assert table_for_key("invalid", "prod") == "dev_customers_silver"
    df = spark.createDataFrame([(key,) for key in cases], "k string")
    assert {r[0]: r[1] for r in df.select("k", table_of_key(F.col("k"))).collect()} == cases
    assert df.select(table_of_key(F.lit("a"), "prod")).first()[0] == "dev_customers_silver"


def test_overwrite_replaces_rows_and_schema_and_counts_them(spark):
    name = unique("t")
    assert write_table(spark.range(5), name) == 5
    assert write_table(spark.range(3).select(F.lit("x").alias("a"), "id"), name) == 3
    assert spark.table(name).columns == ["a", "id"] and spark.table(name).count() == 3
    assert write_table(spark.range(2).select(F.lit("y").alias("a"), "id"), name, mode="append") == 2
    assert spark.table(name).count() == 5


def test_partitioned_table_at_a_path(spark, tmp_path):
    name, path = unique("t"), str(tmp_path / "table")
    df = spark.range(6).select("id", (F.col("id") % 2).alias("day"))
    assert write_table(df, name, partition_by=["day"], path=path) == 6
    assert spark.read.parquet(path + "/day=1").count() == 3


def test_preview(spark, capsys):
    df = spark.range(50).select((49 - F.col("id")).alias("k"))
    assert [r["k"] for r in preview(df, 3, ["k"]).collect()] == [0, 1, 2]
    assert preview(df).count() == 10
    show_preview(df, 2, schema=True)
    out = capsys.readouterr().out
    assert "only showing top 2 rows" in out and "k: long" in out


def test_reports(spark, tmp_path):
    config = JobConfig("load", "r1", env="dev", bucket="b", object_key="k")
    name = unique("runs")
    moment = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    append_report(run_report(spark, config, 7, ["t"], reported_at=moment), name)
    append_report(run_report(spark, config, error="boom"), name)
    good, bad = spark.table(name).orderBy("event_type", ascending=False).collect()
    assert (good["event_type"], good["records_processed"], good["output_paths"], good["error"]) == ("job_success", 7, ["t"], None)
    assert (good["environment"], good["job_name"], good["job_run_id"], good["trigger_type"]) == ("dev", "load", "r1", "s3_event")
    assert (bad["event_type"], bad["error"], bad["records_processed"]) == ("job_failure", "boom", None)


# Jobs


def write_customers(path, rows=GOOD, sep=",", header="customer_id,first_name,last_name,email,phone"):
    lines = [header.replace(",", sep)] + [sep.join("" if v is None else str(v) for v in row) for row in rows]
    path.write_text("\n".join(lines) + "\n")


SCHEMA_AS_TEXT = "customer_id bigint, first_name string, last_name string, email string, phone string"

FIXTURE = [
    (1, "John", "Doe", "john.doe@example.com", "555-123-4567"),
    (2, "Jane", "Smith", "JANE@EXAMPLE.COM", None),
    (3, "Bob", "Johnson", "bob.johnson@invalid", None),
    (4, "Amy", None, "amy@example.org", "5551234567"),
    (5, "Al", "O'Neil", " al@example.org ", "+1-555-456-7890"),
    (6, "Eve", "Fox", None, None),
    (7, "Max", "Ray", "max@example.com", None),
    (8, "Ida", "Orr", "ida@example.com", None),
    (9, "Lou", "Dee", "lou@example.com", None),
    (10, "Kim", "Lee", "kim@example.com", None),
]


class Recording(LakeJob):
    """A job that writes nothing outside its test."""

    entity, layer = "things", "silver"
    required_columns = ["id"]
    frame = None
    stop_at = None

    def extract(self):
        return self.frame

    def transform(self, df):
        if self.stop_at == "transform":
            raise ValueError("transform failed")
        return df.withColumn("twice", F.col("id") * 2)


def job_of(kind, spark, tmp_path, env="dev", **options):
    places = {"table_path": str(tmp_path / "out"), "report_table": unique("runs"), "report_path": str(tmp_path / "runs")}
    return kind(JobConfig("j", "r1", env=env, log_level="ERROR"), spark, **places, **options)


def test_clean_customers_uses_cleaned_names(spark):
    df = spark.createDataFrame([(1, " Ann ", "!!", "A@B.CO", None), (2, None, "Lee", "x", None)], CUSTOMER)
    rows = clean_customers(df).orderBy("customer_id").collect()
    assert [(r["first_name"], r["last_name"], r["email"], r["full_name"]) for r in rows] == [
        ("Ann", None, "a@b.co", "Ann"), (None, "Lee", None, None),
    ]


def test_customer_job_from_files_to_table_and_report(spark, tmp_path):
    write_customers(tmp_path / "a.csv", FIXTURE[:6])
    write_customers(tmp_path / "b.csv", FIXTURE[6:])
    moment = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    job = job_of(CustomersJob, spark, tmp_path, base_path=str(tmp_path), run_time=moment)
    assert job.run() is True
    assert job.quality["email_rate"] == 0.8 and job.quality["name_rate"] == 1.0
    table = spark.table("dev_customers_silver")
    assert table.count() == 10 and table.filter(F.col("email").isNull()).count() == 2
    assert [r["full_name"] for r in table.filter("customer_id IN (4, 5)").orderBy("customer_id").collect()] == ["Amy", "Al O'Neil"]
    stamps = table.select("processed_timestamp", "processed_by_job", "job_run_id").distinct().collect()
    assert len(stamps) == 1 and tuple(stamps[0])[1:] == ("j", "r1")
    report = spark.table(job.report_table).first()
    assert (report["event_type"], report["records_processed"]) == ("job_success", 10)
    assert report["output_paths"] == ["dev_customers_silver"] and report["trigger_type"] == "scheduled"
    assert spark.range(1).count() == 1  # the session is still there


def test_customer_job_prefers_tab_separated_files_and_reads_single_files(spark, tmp_path):
    write_customers(tmp_path / "a.csv", FIXTURE[:3])
    write_customers(tmp_path / "a.dat", FIXTURE, sep="\t")
    job = job_of(CustomersJob, spark, tmp_path, base_path=str(tmp_path))
    assert job.extract().count() == 10
    config = job.config.with_(bucket=str(tmp_path), object_key="a.csv")
    assert CustomersJob(config, spark, scheme="file").extract().count() == 3


def test_customer_job_with_a_schema_infers_nothing(spark, tmp_path):
    write_customers(tmp_path / "a.csv", FIXTURE)
    job = job_of(CustomersJob, spark, tmp_path, base_path=str(tmp_path), schema=SCHEMA_AS_TEXT)
    assert job.extract().dtypes[0] == ("customer_id", "bigint")
    assert job.run() is True and spark.table("dev_customers_silver").count() == 10


def test_customer_job_in_the_local_environment(spark, tmp_path, capsys):
    write_customers(tmp_path / "customers.csv", FIXTURE)
    job = job_of(CustomersJob, spark, tmp_path, env="local", base_path=str(tmp_path))
    assert job.run() is True
    assert "John Doe" in capsys.readouterr().out and not (tmp_path / "out").exists()
    write_customers(tmp_path / "customers.dat", FIXTURE[:2], sep="\t")
    assert job.extract().count() == 2


def test_failed_gate_raises_and_is_reported(spark, tmp_path):
    write_customers(tmp_path / "a.csv", [(1, "A", "B", "bad", None), (2, "A", "B", "bad", None), (3, "A", "B", "a@b.co", None)])
    job = job_of(CustomersJob, spark, tmp_path, base_path=str(tmp_path))
    with pytest.raises(RuntimeError, match="quality gate"):
        job.run()
    report = spark.table(job.report_table).first()
    assert report["event_type"] == "job_failure" and "quality gate" in report["error"]
    assert not (tmp_path / "out").exists()


def test_missing_columns_fail_before_the_transform(spark, tmp_path):
    write_customers(tmp_path / "a.csv", [(1, "A")], header="customer_id,first_name")
    with pytest.raises(RuntimeError, match="columns are missing.*email"):
        job_of(CustomersJob, spark, tmp_path, base_path=str(tmp_path)).run()


def test_nothing_to_do_is_a_success_without_a_report(spark, tmp_path):
    for frame in (None, spark.createDataFrame([], "id int")):
        job = job_of(Recording, spark, tmp_path)
        job.frame = frame
        assert job.run() is True
        assert not spark.catalog.tableExists(job.report_table)


def test_validate_order(spark, tmp_path):
    job = job_of(Recording, spark, tmp_path)
    assert job.validate(None) is False
    assert job.validate(spark.createDataFrame([], "id int")) is False
    assert job.validate(spark.createDataFrame([(1,)], "x int")) is False
    assert job.validate(spark.range(1)) is True


def test_errors_are_reported_and_raised_and_a_lost_report_is_not_an_error(spark, tmp_path):
    job = job_of(Recording, spark, tmp_path)
    job.frame, job.stop_at = spark.range(3), "transform"
    with pytest.raises(ValueError, match="transform failed"):
        job.run()
    assert spark.table(job.report_table).first()["error"] == "ValueError: transform failed"
    job.stop_at, job.report_table = None, "no.such.catalog.table"
    assert job.run() is True
    assert spark.table("dev_things_silver").count() == 3


def product_response(spark_rows):
    return json.dumps({"data": spark_rows, "pagination": {"page": 1, "has_more": False}}, indent=1)


PRICES = [5.0, 10.0, 19.99, 25, 49.99, 30.5, 50, 75, 120.25, 999.99]


def test_product_job_from_pages_to_table(spark, tmp_path):
    first = [{"id": i, "name": f"n{i}", "category": "c", "price": 10.0, "description": None} for i in range(100)]
    second = [{"id": 100 + i, "name": None if i == 0 else "pp", "price": None if i == 1 else p} for i, p in enumerate(PRICES)]
    pages = pages_from_responses(spark, [product_response(first), product_response(second), product_response(first)])
    job = job_of(ProductsJob, spark, tmp_path, pages=lambda: pages)
    assert job.run() is True
    table = spark.table("dev_products_bronze")
    assert table.count() == 108 and dict(table.dtypes)["price"] == "decimal(10,2)"
    counts = {r[0]: r[1] for r in table.filter("id >= 100").groupBy("price_category").count().collect()}
    assert counts == {"mid_range": 4, "premium": 4}
    assert table.filter("id = 102").first()["name_length"] == 2


def test_product_job_in_the_local_environment(spark, tmp_path, capsys):
    rows = [{"id": i, "name": f"product {i}", "category": "c", "price": p} for i, p in enumerate(PRICES)]
    (tmp_path / "p.json").write_text(product_response(rows))
    job = job_of(ProductsJob, spark, tmp_path, env="local", documents=str(tmp_path / "p.json"))
    assert job.run() is True
    out = capsys.readouterr().out
    assert "product 9" in out and "price: decimal(10,2)" in out
    counts = {r[0]: r[1] for r in enrich_products(job.extract()).groupBy("price_category").count().collect()}
    assert counts == {"budget": 1, "mid_range": 5, "premium": 4}


def test_too_few_products_fail(spark, tmp_path):
    pages = pages_from_responses(spark, [product_response([{"id": 1, "name": "a", "price": 1}])])
    with pytest.raises(RuntimeError, match="quality gate"):
        job_of(ProductsJob, spark, tmp_path, pages=lambda: pages).run()
    assert job_of(ProductsJob, spark, tmp_path).run() is True  # no pages, nothing to do


def test_config_and_arguments():
    config = JobConfig.from_args(["x", "--JOB_NAME", "load", "--env", "prod", "--bucket", "b", "--object_key", "k", "--extra", "1"])
    assert (config.job_name, config.env, config.trigger_type, config.enable_report) == ("load", "prod", "s3_event", True)
    assert config.job_run_id.startswith("local-")
    off = JobConfig.from_args(["--JOB_NAME", "load", "--JOB_RUN_ID", "7", "--enable_notifications", "False", "--bucket", "b"])
    assert (off.job_run_id, off.enable_report, off.is_event_triggered, off.env) == ("7", False, False, "local")
    for bad in ({"env": "qa"}, {"log_level": "LOUD"}):
        with pytest.raises(ValueError):
            JobConfig("j", **bad)
    with pytest.raises(TypeError):
        JobConfig("j", colour="red")


def test_command_line(spark, tmp_path, capsys):
    write_customers(tmp_path / "customers.csv", FIXTURE)
    assert main(["customers", "--JOB_NAME", "load", "--base_path", str(tmp_path), "--LOG_LEVEL", "ERROR"]) == 0
    assert "John Doe" in capsys.readouterr().out
    assert main([]) == main(["other"]) == 2
    spark.range(250).selectExpr("id", "timestamp'2024-01-02' AS processed_timestamp").createOrReplaceTempView("cli_rows")
    arguments = ["--table", "cli_rows", "--order_by", "id", "--send", "builtins:len", "--as_of", "2024-01-03"]
    assert main(["export", *arguments]) == 0
    assert "'total_batches': 3" in capsys.readouterr().out


def test_customers_are_read_by_header_and_parsed_once(spark, tmp_path):
    write_customers(tmp_path / "a.csv", FIXTURE)
    job = job_of(CustomersJob, spark, tmp_path, base_path=str(tmp_path))
    found = job.extract()
    assert found.dtypes[0] == ("customer_id", "bigint")
    # What comes later reads the staged copy.
    assert "/lakejobs/" in found.inputFiles()[0] and "a.csv" not in found._jdf.queryExecution().toString()
    write_customers(tmp_path / "b.csv", [("x@y.co", "A", "B", 7, None)], header="email,first_name,last_name,customer_id,phone")
    with pytest.raises(Exception, match="(?i)header"):
        job.extract()


def test_only_partitions_with_new_rows_change(spark, tmp_path):
    name, path = "partitions_that_stay", str(tmp_path / "t")
    df = spark.range(30).select((F.col("id") % 3).cast("int").alias("day"), "id").withColumn("v", F.lit("a"))
    write_table(df, name, partition_by=["day"], path=path, options={"compression": "gzip"})

    def files(day):
        return sorted(f.name for f in (tmp_path / "t" / f"day={day}").iterdir() if f.suffix == ".parquet")

    kept, old = files(0), files(1)
    assert all(".gz." in f for f in kept)
    new = spark.createDataFrame([(1, "b", 100), (7, "b", 101)], "day int, v string, id bigint")
    assert overwrite_partitions(new, name) == 2
    assert files(0) == kept and files(1) != old
    rows = sorted((r["day"], r["id"], r["v"]) for r in spark.table(name).collect())
    assert rows == sorted([(i % 3, i, "a") for i in range(30) if i % 3 != 1] + [(1, 100, "b"), (7, 101, "b")])
    assert overwrite_partitions(new.limit(0), name) == 0 and spark.table(name).count() == 22
    with pytest.raises(ValueError):
        overwrite_partitions(new.drop("v"), name)
    write_table(df, "no_partitions", path=str(tmp_path / "u"))
    with pytest.raises(ValueError):
        overwrite_partitions(df, "no_partitions")
