"""Routes against a plain loop, on both ways of joining them."""

import random

import pytest
from pyspark.sql import functions as F

from lakejobs.operators import routing
from lakejobs.operators.bounded import BroadcastLimit, salted_join
from lakejobs.operators.notifications import dispatch_plan
from lakejobs.operators.routing import default_route, parse_route_specs, route_jobs, route_longest_prefix

NOTHING_FITS = BroadcastLimit(rows=0)


def specs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, spec string")


def test_specs_skip_bad_entries_and_the_last_of_a_prefix_wins(spark):
    text = " a/:one ,nocolon, b/ : two:three,a/: four ,:empty,c/:,\td/\t:\n tabbed \n"
    rows = parse_route_specs(specs(spark, text, "", "x:y"), keys=("id",)).collect()
    assert sorted(tuple(r) for r in rows) == [
        (0, "", "empty"), (0, "a/", "four"), (0, "b/", "two:three"), (0, "c/", ""), (0, "d/", "tabbed"), (2, "x", "y"),
    ]


def test_default_routes(spark):
    keys = ["sales/a", "customers/a", "inventory/a", "products/a", "unknown/a", "Sales/a", "sales", "", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r[0] for r in df.select(default_route(F.col("k"), "test")).collect()] == [
        "test-sales_etl", "test-customer_import", "test-inventory_sync", "test-product_catalog",
    ] + [None] * 5


@pytest.mark.parametrize("limit", [BroadcastLimit(), NOTHING_FITS])
def test_custom_routes_come_first(spark, limit):
    routes = parse_route_specs(specs(spark, "data/:job1,data/special/:job2,sales/:,:never"))
    keys = ["data/special/file.csv", "data/file.csv", "sales/x", "customers/x", "other", "", None]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, object_key string")
    got = route_jobs(df, routes, limit=limit).orderBy("i").collect()
    # An empty job is no job, so the default route applies.
    assert [r["job_name"] for r in got] == ["job2", "job1", "dev-sales_etl", "dev-customer_import", None, None, None]


def longest(key, routes):
    fitting = [p for p in routes if p and key is not None and key.startswith(p)]
    return routes[max(fitting, key=len)] if fitting else None


@pytest.mark.parametrize("one_tier", [0, 1000])
@pytest.mark.parametrize("limit", [BroadcastLimit(), BroadcastLimit(row_chars=5), NOTHING_FITS])
def test_longest_prefix_against_brute_force(spark, monkeypatch, limit, one_tier):
    monkeypatch.setattr(routing, "ONE_TIER_ROUTES", one_tier)
    rng = random.Random(3)
    routes = {"".join(rng.choices("ab/", k=rng.randint(0, 12))): f"j{i}" for i in range(150)}
    hot = "ab/ab/x"
    keys = ["".join(rng.choices("ab/c", k=rng.randint(0, 14))) for _ in range(400)] + [hot] * 300 + [None, "", "\u00e9a"]
    routes["\u00e9"] = "accent"
    df = spark.createDataFrame(list(enumerate(keys)), "i int, object_key string").repartition(4)
    table = spark.createDataFrame(list(routes.items()), "prefix string, job string")
    got = route_longest_prefix(df, table, limit=limit)
    assert got.columns == ["i", "object_key", "job_name"]
    assert {r["i"]: r["job_name"] for r in got.collect()} == {i: longest(k, routes) for i, k in enumerate(keys)}
    assert got.count() == len(keys)


@pytest.mark.parametrize("limit", [BroadcastLimit(), NOTHING_FITS])
def test_no_routes_at_all(spark, limit):
    empty = spark.createDataFrame([], "prefix string, job string")
    df = spark.createDataFrame([(1, "sales/x")], "i int, object_key string")
    assert route_longest_prefix(df, empty, limit=limit).first()["job_name"] is None
    assert route_jobs(df, empty, "qa", limit=limit).first()["job_name"] == "qa-sales_etl"


def test_limit_measures_rows_and_text(spark):
    df = spark.range(10).select("id", F.lit("x" * 10).alias("t"), F.lit(None).cast("string").alias("n"))
    copy = BroadcastLimit(10, 10).local_copy(df, ["t", "n"])
    assert copy.schema == df.schema and sorted(copy.collect()) == sorted(df.collect())
    assert BroadcastLimit(9, 10).local_copy(df, ["t", "n"]) is None
    assert BroadcastLimit(10, 9).local_copy(df, ["t", "n"]) is None
    assert BroadcastLimit().local_copy(df.limit(0), ["t"]).count() == 0


@pytest.mark.parametrize("partitions", [None, 3, 5, 1000])
def test_salted_join_keeps_every_pair(spark, partitions):
    key = F.when(F.col("id") < 700, 0).when(F.col("id") < 800, None).otherwise(F.col("id") % 7)
    large = spark.range(1000).select("id", key.alias("k"), F.create_map(F.lit("a"), "id").alias("m"))
    small = spark.createDataFrame([(0, "a"), (0, "b"), (3, "c"), (99, "d"), (None, "e")], "k int, v string")
    for how in ("inner", "left"):
        want = large.join(small, "k", how).select("id", "k", "v")
        got = salted_join(large, small, ["k"], how=how, partitions=partitions).select("id", "k", "v")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_salted_join_of_nothing(spark):
    none = spark.createDataFrame([], "id int, k int")
    small = spark.createDataFrame([(0, "a")], "k int, v string")
    assert salted_join(none, small, ["k"]).count() == 0
    assert salted_join(small, none, ["k"], how="left").collect()[0]["id"] is None


@pytest.fixture
def plain_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def task_sizes(large, small, **options):
    joined = salted_join(large, small, ["k"], how="left", **options).withColumn("p", F.spark_partition_id())
    return [r["count"] for r in joined.groupBy("p").count().collect()]


def test_hot_and_missing_keys_are_spread(spark, plain_joins):
    key = F.when(F.col("id") < 5000, 0).when(F.col("id") < 8000, None).otherwise(F.col("id"))
    large = spark.range(9000).select("id", key.alias("k"))
    small = spark.range(9000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    sizes = task_sizes(large, small)
    assert sum(sizes) == 9000 and max(sizes) < 3000


def test_equal_rows_and_many_warm_keys_are_spread(spark, plain_joins):
    """One key of equal rows; and a thousand keys, each a thousandth of the rows, over many partitions."""
    small = spark.range(1000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    equal = task_sizes(spark.range(8000).select(F.lit(7).alias("k")), small)
    assert sum(equal) == 8000 and len(equal) >= 4 and max(equal) <= 3000
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        warm = task_sizes(spark.range(40_000).select((F.col("id") % 40).alias("k")), small, partitions=400)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(warm) == 40_000 and max(warm) < 1000


def test_ties_of_routes_go_alike_on_both_ways(spark):
    routes = spark.createDataFrame([("a/", "j2"), ("a/", "j1"), ("b/", None), ("b/", "x")], "prefix string, job string")
    keys = spark.createDataFrame([("a/1",), ("b/1",), ("c/1",)], "object_key string")
    for limit in (BroadcastLimit(), BroadcastLimit(rows=1)):
        routed = route_longest_prefix(keys, routes, limit=limit)
        assert sorted(tuple(r) for r in routed.collect()) == [("a/1", "j1"), ("b/1", None), ("c/1", None)]


def test_messages_are_read_once_on_the_way_for_many_routes(spark):
    messages = spark.createDataFrame([(1, '{"bucket":"b","object_key":"a/1"}')], "i int, message string")
    routes = spark.createDataFrame([("a/", "j1"), ("b/", "j2")], "prefix string, job string")
    plan = dispatch_plan(messages, routes, keys=("i",), limit=BroadcastLimit(rows=1))
    assert "parse_json" not in plan._jdf.queryExecution().toString().lower()
    assert [r["job_name"] for r in plan.collect()] == ["j1"]
