"""Selection, batches, delivery and whole exports."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakejobs.config import ExportRequest
from lakejobs.operators.batching import (
    batch_payloads,
    batch_records,
    deliver_batches,
    delivery_summary,
    first_rows,
    first_rows_cut,
    number_rows,
    ordered_payloads,
)
from lakejobs.operators.selection import capped, matching, on_dates, row_cap
from lakejobs.plans.export import export_rows, export_table
from lakejobs.session import fresh_path, shared_dir, stage

DAYS = [f"2024-01-{day:02d} {time}" for day in range(5, 19) for time in ("00:00:00", "12:30:00", "23:59:59")]


@pytest.fixture(params=["timestamp", "timestamp_ntz"])
def stamped(spark, request):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DAYS)], "i int, d string")
    return df.withColumn("processed_timestamp", F.col("d").cast(request.param))


def days(df):
    return sorted({r["d"][:10] for r in df.collect()})


def test_date_filters(stamped):
    assert days(on_dates(stamped, "today", "2024-01-12")) == ["2024-01-12"]
    assert on_dates(stamped, "today", "2024-01-12").count() == 3
    assert days(on_dates(stamped, "yesterday", "2024-01-12")) == ["2024-01-11"]
    assert days(on_dates(stamped, "last_week", "2024-01-12")) == [f"2024-01-{d:02d}" for d in range(5, 19)]
    assert days(on_dates(stamped, "last_week", "2024-01-15"))[0] == "2024-01-08"
    assert on_dates(stamped, "other", "2024-01-12").count() == len(DAYS)
    assert on_dates(stamped, None).count() == len(DAYS)


def test_date_filters_follow_the_current_date(spark):
    df = spark.range(1).select(
        F.explode(F.array(F.current_timestamp(), F.current_timestamp() - F.expr("INTERVAL 1 DAY"))).alias("processed_timestamp")
    )
    assert on_dates(df, "today").count() == 1
    assert on_dates(df, "yesterday").count() == 1
    assert on_dates(df, "last_week").count() == 2


def test_where_with_or_binds_as_one_condition(stamped):
    rows = matching(on_dates(stamped, "today", "2024-01-12"), "i = 0 OR i >= 22")
    assert sorted(r["i"] for r in rows.collect()) == [22, 23]
    assert matching(stamped, None).count() == matching(stamped, "").count() == len(DAYS)


def test_caps():
    caps = [(None, 10), (0, 10), (5, 10), (50, 10), (5, None), (None, None), (0, None)]
    assert [row_cap(*c) for c in caps] == [10, 10, 5, 10, 5, None, None]
    with pytest.raises(ValueError):
        row_cap(-1, 10)


def test_capped_rows_are_the_first(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k")).repartition(5)
    assert sorted(r["k"] for r in capped(df, ["k"], 7, 100).collect()) == list(range(7))
    assert capped(df, ["k"], None, 1000).count() == 100


@pytest.mark.parametrize("partitions", [None, 3, 20])
def test_numbers_over_ranges_are_dense_and_ordered(spark, partitions):
    # One value of the leading sort column holds most rows.
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 10 == 0).cast("int").alias("g"))
    rows = number_rows(df.repartition(7), ["g", "k"], partitions=partitions).collect()
    ordered = sorted((r["g"], r["k"]) for r in df.collect())
    assert {r["rn"]: (r["g"], r["k"]) for r in rows} == dict(enumerate(ordered, 1))
    assert {r["total"] for r in rows} == {5000}


@pytest.mark.parametrize("limit", [1, 10, 95, 100, 1000])
def test_limited_numbers_are_the_first_ones(spark, limit):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    rows = sorted((r["rn"], r["k"], r["total"]) for r in number_rows(df, ["k"], limit).collect())
    n = min(limit, 100)
    assert rows == [(i + 1, i, n) for i in range(n)]


@pytest.mark.parametrize("n, size", [(0, 10), (1, 10), (10, 10), (11, 10), (95, 10), (7, 1)])
def test_batches_partition_the_input(spark, n, size):
    df = spark.range(n).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("x"))
    payloads = batch_payloads(batch_records(df, ["k"], size)).orderBy("batch_number").collect()
    total = -(-n // size)
    assert [p["batch_number"] for p in payloads] == list(range(1, total + 1))
    assert [p["records"] for p in payloads] == [size] * (n // size) + ([n % size] if n % size else [])
    sent = [json.loads(p["payload"]) for p in payloads]
    assert all(list(s) == ["batch_number", "total_batches", "records"] for s in sent)
    assert all(s["total_batches"] == total for s in sent)
    assert [r for s in sent for r in s["records"]] == [{"k": str(i), "x": None} for i in range(n)]


@pytest.mark.parametrize("limit", [1, 50, 900])
def test_first_rows_are_cut_off_before_anything_moves(spark, tmp_path, limit):
    """The bound on the leading column reaches the scan, and few rows are left for the sort."""
    df = spark.range(20_000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 100 > 0, F.concat(F.lit("key-"), F.lpad((F.col("id") * 7919 % 20_000).cast("string"), 6, "0"))).alias("s"),
        (F.col("id") % 3).alias("g"),
        F.timestamp_seconds(F.col("id") * 61 % 20_000).alias("ts"),
    )
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for column in ("n", "s", "ts", "g"):
        kept = first_rows_cut(df, [column], limit)
        wanted = [r[0] for r in df.orderBy(column, "n").limit(limit).select("n").collect()]
        assert [r[0] for r in kept.orderBy(column, "n").limit(limit).select("n").collect()] == wanted
        if column != "g":
            # 200 rows share the null of `s`, which comes first.
            assert kept.count() <= max(2 * limit, 200)
            assert column == "s" and limit < 200 or f"LessThanOrEqual({column}" in kept._jdf.queryExecution().toString()


def test_rows_of_one_stem_are_cut_off_by_the_whole_sort_tuple(spark, tmp_path):
    """Long common stems, and a leading value that all rows share."""
    n = F.col("id") * 7919 % 20_000
    url = F.concat(F.lit("https://example.org/catalogue/items/"), F.lpad(n.cast("string"), 6, "0"))
    spark.range(20_000).select(F.lit("same").alias("g"), url.alias("url"), F.when(n % 3 > 0, n).alias("n")).repartition(
        4
    ).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for order in (["url"], ["g", "url"], ["g", "n", "url"]):
        for limit in (1, 700, 30_000):
            kept = first_rows_cut(df, order, limit)
            wanted = [tuple(r) for r in df.orderBy(*order).limit(limit).collect()]
            assert [tuple(r) for r in kept.orderBy(*order).limit(limit).collect()] == wanted
            assert [tuple(r) for r in first_rows(df, order, limit).orderBy(*order).collect()] == wanted
            assert limit == 30_000 or kept.count() <= 2 * limit
    assert "LessThanOrEqual(url" in plan_text(first_rows_cut(df, ["url"], 700))


def plan_text(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("limit", [None, 1, 300, 1234, 5000])
@pytest.mark.parametrize("order", [["k"], ["g", "k"], ["x", "k"], ["g"]])
def test_payloads_of_ranges_are_those_of_numbered_rows(spark, order, limit):
    """Nulls first, NaN last; ties of `g` alone leave which rows stand in a batch open, but not how many."""
    i = F.col("id")
    x = F.when(i % 4 == 0, F.lit(None)).when(i % 4 == 1, F.lit(float("nan"))).otherwise(i / 7)
    df = spark.range(2345).select((i * 7919 % 2345).alias("k"), (i % 3).cast("string").alias("g"), x.alias("x")).repartition(5)
    got = ordered_payloads(df, order, 10, limit).orderBy("batch_number").collect()
    want = batch_payloads(batch_records(df, order, 10, limit)).orderBy("batch_number").collect()
    if order == ["g"]:
        got, want = ([r[:3] for r in rows] for rows in (got, want))
    assert got == want


def test_payloads_of_nothing(spark):
    df = spark.range(0).withColumn("x", F.lit("a"))
    assert ordered_payloads(df, ["id"], 10).collect() == [] == ordered_payloads(df, ["id"], 10, 5).collect()


def test_text_of_payloads_moves_once(spark):
    df = spark.range(5000).withColumn("text", F.repeat(F.lit("x"), 50))
    plan = ordered_payloads(df, ["id"], 10)._jdf.queryExecution().executedPlan().toString()
    main = plan.partition("Subquery")[0]
    assert main.count("Exchange") == 1 and "FileScan" not in main


def outbox(path, failing=lambda body: False):
    def send(payload):
        body = json.loads(payload)
        if failing(body):
            raise ValueError(f"no {body['batch_number']}")
        with open(os.path.join(path, str(body["batch_number"])), "a") as f:
            f.write("x")

    return send


def test_a_failing_batch_does_not_stop_the_rest_and_nothing_is_sent_twice(spark, tmp_path):
    payloads = batch_payloads(batch_records(spark.range(95), ["id"], 10))
    status = deliver_batches(payloads, outbox(str(tmp_path), lambda body: body["batch_number"] in (2, 5)))
    for _ in range(2):
        rows = sorted(tuple(r) for r in status.collect())
    assert [r[0] for r in rows if not r[2]] == [2, 5] and rows[1][3] == "no 2" and rows[0][3] is None
    assert delivery_summary(status, 10).first().asDict() == {
        "total_records": 95, "total_batches": 10, "successful_batches": 8, "failed_batches": 2, "success_rate": 0.8,
    }
    assert sorted(os.listdir(tmp_path), key=int) == ["1", "3", "4", "6", "7", "8", "9", "10"]
    assert {(tmp_path / name).read_text() for name in os.listdir(tmp_path)} == {"x"}


def test_a_sender_holds_few_payloads_at_once(spark):
    """Whatever the number of payloads of a task: the worker keeps a few megabytes of Arrow batches, not tens of them."""
    payloads = spark.range(400, numPartitions=1).selectExpr("id AS batch_number", "1L AS records", "repeat('x', 100000) AS payload")

    def send(payload):
        import gc

        import pandas
        import pyarrow

        if pyarrow.total_allocated_bytes() > 16 << 20 or any(isinstance(x, pandas.DataFrame) for x in gc.get_objects()):
            raise ValueError("too much")

    status = deliver_batches(payloads, send)
    assert status.filter("ok").count() == 400, status.first()


def test_no_records_no_batches(spark):
    status = spark.createDataFrame([], "batch_number bigint, records bigint, ok boolean, error string")
    assert delivery_summary(status).first().asDict() == {
        "total_records": 0, "total_batches": 0, "successful_batches": 0, "failed_batches": 0, "success_rate": 0.0,
    }


def test_requests():
    nightly = ExportRequest.scheduled("t", "last_week", "x > 1")
    assert (nightly.date_filter, nightly.where, nightly.limit, nightly.batch_size) == ("last_week", "x > 1", None, 100)
    assert ExportRequest.scheduled().table == "dev_customers_silver"
    event = ExportRequest.object_event("silver/customers/part.parquet", "prod")
    assert (event.table, event.date_filter, event.where, event.limit) == ("prod_customers_silver", "today", None, None)
    asked = ExportRequest.on_demand("t", where="a = 1")
    assert (asked.table, asked.date_filter, asked.where, asked.limit) == ("t", "yesterday", "a = 1", None)
    with pytest.raises(ValueError):
        ExportRequest.scheduled("t", "sometime")


def test_export_delivers_the_capped_rows(spark, stamped, tmp_path):
    request = ExportRequest.scheduled("t", "last_week", "i <> 20", as_of="2024-01-12", max_records=25, batch_size=10)
    got = export_rows(stamped, request, outbox(str(tmp_path)), ["i"]).first().asDict()
    assert got["total_records"] == 25 and got["successful_batches"] == 3 and got["success_rate"] == 1.0
    assert got["delivered_records"] == 25 and got["truncated"] and got["selected_records"] > 25
    assert sorted(os.listdir(tmp_path)) == ["1", "2", "3"]


def staged(spark):
    folder = os.path.join(shared_dir(spark), "lakejobs", spark.sparkContext.applicationId)
    return set(os.listdir(folder)) if os.path.exists(folder) else set()


def test_finished_work_leaves_nothing_in_the_shared_folder(spark):
    spark.range(10).selectExpr("id", "current_timestamp() AS processed_timestamp").createOrReplaceTempView("fresh_rows")
    before = staged(spark)
    result = export_table(spark, ExportRequest.scheduled("fresh_rows", "today"), len, ["id"])
    assert result["total_records"] == 10 and staged(spark) == before
    kept = stage(spark.range(5), "kept")
    assert len(staged(spark)) == len(before) + 1 and kept.count() == 5


def test_the_shared_folder_is_the_one_the_session_names(spark):
    assert fresh_path(spark, "x").startswith(f'{spark.conf.get("spark.checkpoint.dir")}/lakejobs/{spark.sparkContext.applicationId}/x-')
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_export_of_a_table(spark, stamped, tmp_path):
    stamped.createOrReplaceTempView("lake_rows")
    request = ExportRequest.on_demand("lake_rows", as_of="2024-01-12")
    columns = ["i", "processed_timestamp"]
    result = export_table(spark, request, outbox(str(tmp_path)), ["i"], columns)
    assert result["status"] == "delivered" and result["total_records"] == 3 and result["total_batches"] == 1
    none = export_table(spark, ExportRequest.on_demand("lake_rows", as_of="2030-01-01"), outbox(str(tmp_path)), ["i"])
    assert none == {"status": "no_data", "total_records": 0}
