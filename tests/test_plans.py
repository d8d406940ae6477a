"""What the physical plans must look like for the work to scale."""

import re

import pytest
from pyspark.sql import functions as F

from lakejobs.operators.notifications import dispatch_plan, normalize_messages, rule_targets, unwrap_envelopes
from lakejobs.operators.routing import parse_route_specs
from lakejobs.sources.api_pages import parse_response
from suite.queries import QUERIES

ROW_BY_ROW = [
    "detect_format", "table_from_key", "clean_email", "standardize_phone", "standardize_name", "full_name",
    "categorize_amount", "when_category", "add_metadata", "json_cells", "customers_silver", "export_today",
    "export_yesterday", "export_last_week", "export_select", "events_envelope", "events_normalize",
    "event_rule_match", "route_default", "sql_view_filter",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return re.findall(r"FileScan parquet \[(.*?)\]", plan)


@pytest.mark.parametrize("name", ROW_BY_ROW)
def test_row_by_row_queries_do_not_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Exchange" not in plan and "Python" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["export_today", "export_yesterday", "export_last_week", "export_select"])
def test_date_filters_reach_the_scan(spark, sf_dir, name):
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01", plan_of(QUERIES[name](spark, sf_dir)))


def test_scans_read_only_needed_columns(spark, sf_dir):
    columns = scans(plan_of(QUERIES["quality_customers"](spark, sf_dir)))
    assert len(columns) == 1 and "c_acctbal" not in columns[0] and "c_nationkey" not in columns[0]
    assert "props" not in scans(plan_of(QUERIES["export_select"](spark, sf_dir)))[0]


@pytest.mark.parametrize("name", ["quality_base", "quality_customers", "group_count"])
def test_gates_scan_once_and_aggregate_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert len(scans(plan)) == 1 and plan.count("Exchange") == 1 and "partial_count" in plan


def test_top_rows_are_taken_in_each_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["preview"](spark, sf_dir))


def test_routes_are_broadcast_and_events_are_not_shuffled(spark, sf_dir):
    plan = plan_of(QUERIES["dispatch_plan"](spark, sf_dir))
    events, _, routes = plan.partition("BroadcastExchange")
    assert "BroadcastHashJoin" in events and "Exchange" not in events
    assert "NestedLoop" not in plan and "Python" not in plan and routes


def test_messages_are_parsed_once(spark):
    df = spark.createDataFrame([(1, "{}")], "i int, message string")
    routes = parse_route_specs(spark.createDataFrame([("a:b",)], "spec string"))
    rules = spark.createDataFrame([("r", "b", "", "")], "rule string, bucket string, prefix string, suffix string")
    for result in (
        dispatch_plan(df, routes, keys=("i",)),
        normalize_messages(df, keys=("i",)),
        rule_targets(df, rules, keys=("i",)),
        unwrap_envelopes(df, "message", keys=("i",)),
    ):
        assert plan_of(result).count("parseJson(") == 1


def test_responses_are_parsed_once(spark):
    df = spark.createDataFrame([(1, "{}")], "page int, response string")
    plan = plan_of(parse_response(df).filter(F.col("price") > 1))
    assert plan.count("from_json(") == 1


def test_numbering_shuffles_narrow_counts_only(spark, sf_dir):
    plan = plan_of(QUERIES["batch_records"](spark, sf_dir))
    rows, _, offsets = plan.partition("BroadcastExchange")
    assert "Exchange" not in rows and "Window" not in rows
    assert [re.sub(r"#\d+L?", "", c) for c in scans(offsets)] == ["_place"]
