"""Notification shapes, envelopes, rules and dispatch plans."""

import json

import pytest
from pyspark.sql import functions as F

from lakejobs.operators.bounded import BroadcastLimit
from lakejobs.operators.notifications import (
    dispatch_envelopes,
    dispatch_plan,
    dispatch_summary,
    match_rule,
    normalize_messages,
    read_messages,
    rule_targets,
    unwrap_envelopes,
)
from lakejobs.operators.routing import parse_route_specs


def store(bucket="b", key="k", **more):
    return {"eventSource": "aws:s3", "s3": {"bucket": {"name": bucket}, "object": {"key": key}}, **more}


DEFAULT = "ObjectCreated"
CASES = [
    # Shape 1
    ({"Records": [store("lake", "sales/t.csv", eventName="ObjectCreated:Put")]}, [("lake", "sales/t.csv", "ObjectCreated:Put")]),
    ({"Records": [store(key="x"), store(key="y")]}, [("b", "x", DEFAULT), ("b", "y", DEFAULT)]),
    ({"Records": [store(eventName=None)]}, [("b", "k", None)]),
    ({"Records": [{**store(), "eventSource": "aws:sqs"}, {"s3": 1}, {}]}, []),
    ({"Records": [store(bucket=""), store(key=""), {"eventSource": "aws:s3"}, store(key="ok")]}, [("b", "ok", DEFAULT)]),
    ({"Records": [{"eventSource": "aws:s3", "s3": {"bucket": {"name": "b"}}}]}, []),
    ({"Records": [], "bucket": "b", "object_key": "k"}, []),
    ({"Records": None, "bucket": "b", "object_key": "k"}, []),
    ({"Records": {"a": 1}}, []),
    ({"Records": [store(), 5]}, []),
    ({"Records": [store(), None]}, []),
    ({"Records": [store(), {"eventSource": "aws:s3", "s3": None}]}, []),
    ({"Records": [store(), {"eventSource": "aws:s3", "s3": {"bucket": "b", "object": {"key": "k"}}}]}, []),
    ({"Records": [store(), {"eventSource": "aws:s3", "s3": {"bucket": {"name": "b"}, "object": "k"}}]}, []),
    ({"Records": [store(), {"eventSource": "aws:s3", "s3": {"bucket": {"name": ""}, "object": "k"}}]}, [("b", "k", DEFAULT)]),
    ({"Records": [store(), {"eventSource": "other", "s3": None}]}, [("b", "k", DEFAULT)]),
    # Shape 2
    ({"detail-type": "Object Created", "detail": {"bucket": {"name": "b"}, "object": {"key": "c/x"}}}, [("b", "c/x", "Object Created")]),
    ({"detail": {"bucket": {"name": "b"}, "object": {"key": "c/x"}}}, [("b", "c/x", DEFAULT)]),
    ({"detail": {"bucket": {"name": "b"}}, "bucket": "b", "object_key": "k"}, []),
    ({"detail": {"bucket": None}, "bucket": "b", "object_key": "k"}, []),
    ({"detail": {"bucket": "b", "object": {"key": "k"}}, "bucket": "b", "object_key": "k"}, []),
    ({"detail": {"x": 1}, "bucket": "b", "object_key": "k"}, [("b", "k", DEFAULT)]),
    ({"detail": None, "bucket": "b", "object_key": "k"}, []),
    ({"detail": 5, "bucket": "b", "object_key": "k"}, []),
    ({"detail": "see bucket", "bucket": "b", "object_key": "k"}, []),
    ({"detail": "text", "bucket": "b", "object_key": "k"}, [("b", "k", DEFAULT)]),
    ({"detail": ["bucket"], "bucket": "b", "object_key": "k"}, []),
    ({"detail": [1], "Bucket": "b", "Key": "k"}, [("b", "k", DEFAULT)]),
    # Shape 3
    ({"bucket": "b", "object_key": "i/x", "event_name": "ObjectCreated:Put"}, [("b", "i/x", "ObjectCreated:Put")]),
    ({"bucket": "b", "object_key": "i/x", "event_name": None}, [("b", "i/x", None)]),
    ({"bucket": None, "object_key": None}, [(None, None, DEFAULT)]),
    ({"bucket": "", "object_key": "", "bucketName": "z", "key": "k"}, [("", "", DEFAULT)]),
    # Shape 4
    ({"bucketName": "b", "Key": "k", "eventName": "Put"}, [("b", "k", "Put")]),
    ({"s3Bucket": "z", "objectName": "n", "s3Key": "s"}, [("z", "s", DEFAULT)]),
    ({"Bucket": "B", "bucket_name": "b", "Key": "K", "key": "k", "object_key": "o"}, [("b", "o", DEFAULT)]),
    ({"Bucket": "", "s3Bucket": "z", "key": "k"}, []),
    ({"Bucket": None, "s3Bucket": "z", "key": "k"}, []),
    ({"bucket": "b", "key": "k"}, []),
    ({"bucketName": "b%20c", "key": "a+b%2F.csv"}, [("b%20c", "a+b%2F.csv", DEFAULT)]),
    ({}, []),
    ({"invalid": "data"}, []),
    (None, []),
    ([1, 2], []),
    ("Records", []),
    (7, []),
]


@pytest.fixture(scope="module")
def read(spark):
    df = spark.createDataFrame([(i, json.dumps(m)) for i, (m, _) in enumerate(CASES)], "i int, message string")
    return {r["i"]: r for r in read_messages(df, keys=("i",)).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_shapes(read, i):
    assert read[i]["is_readable"]
    assert [tuple(event) for event in read[i]["events"]] == CASES[i][1]


def test_normalized_rows_are_the_events(spark):
    df = spark.createDataFrame([(i, json.dumps(m)) for i, (m, _) in enumerate(CASES)], "i int, message string")
    got = sorted(tuple(r) for r in normalize_messages(df, keys=("i",)).filter(F.col("bucket").isNotNull()).collect())
    want = [(i, n, *e) for i, (_, events) in enumerate(CASES) for n, e in enumerate(events, 1) if e[0] is not None]
    assert [str(r) for r in got] == [str(r) for r in sorted(want, key=lambda r: r[:2])]


def test_envelopes(spark):
    flat = json.dumps({"bucket": "b", "object_key": "k"})
    texts = [
        json.dumps({"Records": [{"EventSource": "aws:sns", "Sns": {"Message": flat, "Timestamp": "t"}}]}),
        json.dumps({"Records": [{"EventSource": "other"}, {"EventSource": "aws:sns", "Sns": {"Message": "m"}}]}),
        json.dumps({"Records": [{"EventSource": "aws:sns"}, {"EventSource": "aws:sns", "Sns": {"Message": {"a": 1}}}]}),
        json.dumps({"Records": []}), "{}", "broken", None, "[1]", '{"Records": 1}', '{"Records": null}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, envelope string")
    rows = sorted((tuple(r) for r in unwrap_envelopes(df, keys=("i",)).collect()), key=lambda r: (r[0], r[1] or 0))
    unreadable = [(i, None, None) for i in (5, 6, 7, 8, 9)]
    assert rows == [(0, 1, flat), (1, 2, "m"), (2, 1, None), (2, 2, None), *unreadable]
    plan = dispatch_envelopes(df, keys=("i",)).filter("record_no IS NULL").collect()
    assert sorted((r["i"], r["status"]) for r in plan) == [(i, "error") for i in (5, 6, 7, 8, 9)]


def test_the_last_of_repeated_keys_counts(spark):
    texts = ['{"bucket":"a","bucket":"b","object_key":"sales/x"}', '{"bucket":"b","Records":1,"Records":[],"object_key":"k"}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, message string")
    rows = sorted((r["i"], r["bucket"], r["status"]) for r in dispatch_plan(df, keys=("i",)).collect())
    assert rows == [(0, "b", "matched"), (1, None, "skipped")]


def test_plan_and_summary(spark):
    messages = {
        0: json.dumps({"Records": [store(key="sales/a"), store(key="data/x/1"), store(key="zzz")]}),
        1: json.dumps({"bucket": "b", "object_key": None}),
        2: json.dumps({"invalid": 1}),
        3: "not json",
        4: None,
        5: json.dumps({"bucket": "b", "object_key": "zzz"}),
    }
    df = spark.createDataFrame(list(messages.items()), "i int, message string")
    routes = parse_route_specs(spark.createDataFrame([("data/:bulk",)], "spec string"))
    plan = dispatch_plan(df, routes, "test", keys=("i",))
    rows = sorted((r["i"], r["event_no"] or 0, r["job_name"], r["status"], r["reason"]) for r in plan.collect())
    assert rows == [
        (0, 1, "test-sales_etl", "matched", None),
        (0, 2, "bulk", "matched", None),
        (0, 3, None, "skipped", "No matching Glue job"),
        (1, 0, None, "error", None),
        (2, 0, None, "skipped", "No S3 events found"),
        (3, 0, None, "error", None),
        (4, 0, None, "error", None),
        (5, 1, None, "skipped", "No matching Glue job"),
    ]
    arguments = plan.filter("job_name = 'bulk'").first()["arguments"]
    assert arguments == {"--bucket": "b", "--object_key": "data/x/1", "--env": "test", "--enable_metrics": "true"}
    summary = {r["i"]: (r["status"], r["jobs_started"]) for r in dispatch_summary(plan, ("i",)).collect()}
    assert summary == {
        0: ("success", 2), 1: ("error", 0), 2: ("skipped", 0), 3: ("error", 0), 4: ("error", 0), 5: ("success", 0),
    }


def bus(bucket, key, source="aws.s3", kind="Object Created"):
    return json.dumps({"source": source, "detail-type": kind, "detail": {"bucket": {"name": bucket}, "object": {"key": key}}})


BUS = [
    bus("b", "in/a.csv"), bus("b", "in/a.txt"), bus("b", "out/a.csv"), bus("c", "in/a.csv"),
    bus("b", "in/a.csv", source="x"), bus("b", "in/a.csv", kind="Object Deleted"), "{}", "broken", None,
]


def test_rule_match(spark):
    df = spark.createDataFrame(list(enumerate(BUS)), "i int, m string").select("i", F.try_parse_json("m").alias("m"))
    got = df.select("i", match_rule(F.col("m"), "b", "in/", ".csv"), match_rule(F.col("m"), "b")).orderBy("i").collect()
    assert [r[1] for r in got] == [True] + [False] * 8
    assert [r[2] for r in got] == [True, True, True] + [False] * 6


@pytest.mark.parametrize("limit", [BroadcastLimit(), BroadcastLimit(rows=0)])
def test_rule_targets(spark, limit):
    df = spark.createDataFrame(list(enumerate(BUS)), "i int, message string")
    rules = spark.createDataFrame(
        [("r1", "b", "in/", ".csv"), ("r2", "b", "", ".csv"), ("r3", "c", "in/", ""), ("r4", "d", "", "")],
        "rule string, bucket string, prefix string, suffix string",
    )
    rows = rule_targets(df, rules, "qa", keys=("i",), limit=limit).collect()
    assert sorted((r["i"], r["rule"]) for r in rows) == [(0, "r1"), (0, "r2"), (2, "r2"), (3, "r3")]
    assert {tuple(sorted(r["arguments"])) for r in rows} == {("--bucket", "--env", "--object_key")}
