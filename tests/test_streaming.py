"""Streams that take in new files and end."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lakejobs.operators.notifications import dispatch_plan
from lakejobs.operators.routing import parse_route_specs
from lakejobs.streaming.dispatch import dispatch_stream
from lakejobs.streaming.ingest import ingest_new_files, stream_files


def test_ingest_takes_each_file_once(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    spark.range(10).withColumn("v", F.lit("a")).repartition(3).write.csv(source, header=True)
    schema = "id bigint, v string"

    def ingest():
        stream = stream_files(spark, source, schema, "csv", "*.csv", max_files=2)
        ingest_new_files(stream, sink, checkpoint, timeout=120)
        return sorted(r["id"] for r in spark.read.parquet(sink).collect())

    assert ingest() == list(range(10))
    assert ingest() == list(range(10))
    spark.range(10, 12).withColumn("v", F.lit("b")).write.mode("append").csv(source, header=True)
    assert ingest() == list(range(12))


def test_dispatch_stream_gives_the_batch_plan_and_repeats_nothing(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    folders = ["sales", "data/x", "other"]
    rows = [(i, json.dumps({"bucket": "b", "object_key": f"{folders[i % 3]}/{i}"}) if i % 5 else "bad") for i in range(60)]
    messages = spark.createDataFrame(rows, "id int, message string")
    messages.repartition(4).write.parquet(source)
    routes = parse_route_specs(spark.createDataFrame([("data/:bulk",)], "spec string"))
    want = sorted(str(r) for r in dispatch_plan(messages, routes, "test", keys=("id",)).collect())
    for _ in range(2):
        stream = stream_files(spark, source, messages.schema, max_files=1)
        dispatch_stream(stream, sink, checkpoint, routes, "test", keys=("id",), timeout=120)
        got = spark.read.parquet(sink)
        assert got.select("batch_id").distinct().count() == 4
        assert sorted(str(r) for r in got.drop("batch_id").collect()) == want


def _noted(bucket, key, sequencer, shape):
    named = {"bucket": {"name": bucket}, "object": {"key": key, "sequencer": sequencer}}
    if shape == "records":
        return json.dumps({"Records": [{"eventSource": "aws:s3", "eventName": "ObjectCreated:Put", "s3": named}]})
    return json.dumps({"source": "aws.s3", "detail-type": "Object Created", "detail": named})


def test_a_notification_that_comes_again_starts_nothing(spark, tmp_path):
    """The same object and sequence number in another message and shape; another number is another upload."""
    source, sink, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    at = dt.datetime(2024, 1, 1)
    first = [
        (1, _noted("b", "sales/1", "s1", "records"), at),
        (2, _noted("b", "sales/1", "s1", "detail"), at),
        (3, _noted("b", "sales/1", "s2", "records"), at),
        (4, json.dumps({"bucket": "b", "object_key": "sales/1"}), at),
        (5, json.dumps({"bucket": "b", "object_key": "sales/1"}), at),
        (6, "no json", at),
        (7, None, at),
    ]
    later = at + dt.timedelta(hours=1)
    second = [(i, m, later) for i, m, _ in first] + [(8, _noted("b", "sales/1", "s3", "detail"), later)]
    schema = "id int, message string, arrived timestamp"
    for rows, want in ((first, [4, 5, 6, 7]), (second, [4, 5, 6, 7, 8]), ([], [4, 5, 6, 7, 8])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = stream_files(spark, source, schema)
        dispatch_stream(stream, sink, checkpoint, None, "test", keys=("id",), timeout=120, once_within="2 hours")
        plan = spark.read.parquet(sink).drop("batch_id").collect()
        ids = sorted(r["id"] for r in plan)
        # Of messages 1 and 2 either may come first.
        assert len([i for i in ids if i in (1, 2)]) == 1 and [i for i in ids if i > 2] == [3, *want]
