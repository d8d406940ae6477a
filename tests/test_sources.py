"""File, catalog and API page sources."""

import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakejobs.config import JobConfig
from lakejobs.sources.api_pages import assemble_pages, pages_from_responses, parse_response, response_files
from lakejobs.sources.catalog import query_view, read_table, table_columns, table_info
from lakejobs.sources.files import (
    data_path,
    detect_format,
    format_of_key,
    read_files,
    read_first_found,
    read_fixture,
)

CUSTOMERS = "customer_id{s}first_name{s}email\n1{s}Ann{s}ann@example.com\n2{s}Bob{s}\n"


def put(path, text):
    path.write_text(text)
    return str(path)


def test_delimited_files_have_header_and_inferred_types(spark, tmp_path):
    for kind, sep in [("csv", ","), ("dat", "\t"), ("tsv", "\t"), ("CSV", ",")]:
        df = read_files(spark, put(tmp_path / f"c_{kind}.x", CUSTOMERS.format(s=sep)), kind)
        assert df.dtypes == [("customer_id", "int"), ("first_name", "string"), ("email", "string")]
        assert [tuple(r) for r in df.collect()] == [(1, "Ann", "ann@example.com"), (2, "Bob", None)]


def test_a_schema_replaces_inference(spark, tmp_path):
    path = put(tmp_path / "c.csv", CUSTOMERS.format(s=","))
    df = read_files(spark, path, "csv", "customer_id string, first_name string, email string")
    assert df.dtypes[0] == ("customer_id", "string") and df.count() == 2


def test_json_lines_and_whole_documents(spark, tmp_path):
    lines = put(tmp_path / "a.json", '{"a":1}\n{"a":2}\n')
    assert sorted(r["a"] for r in read_files(spark, lines, "json").collect()) == [1, 2]
    pretty = put(tmp_path / "b.json", json.dumps({"a": {"b": 1}}, indent=2))
    assert read_files(spark, pretty, "json").columns == ["_corrupt_record"]
    assert read_files(spark, pretty, "json", multi_line=True).select("a.b").first()[0] == 1


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError, match="no reader for format .xml"):
        read_files(spark, "/x", "xml")


def test_detect_format_in_python_and_as_a_column(spark):
    cases = {
        "a/b.csv": "csv", "a/B.DAT": "dat", "b.tsv": "dat", "b.txt": "csv", "b.json": "json",
        "b.PARQUET": "parquet", "b.csv.gz": "csv", "noext": "csv", "dir.json/file": "csv", "": "csv",
    }
    assert {key: detect_format(key) for key in cases} == cases
    df = spark.createDataFrame([(key,) for key in cases], "k string")
    assert {r[0]: r[1] for r in df.select("k", format_of_key(F.col("k"))).collect()} == cases


def test_data_path():
    scheduled = JobConfig("j")
    assert data_path(scheduled, "s3://lake/in", "*.csv") == "s3://lake/in/*.csv"
    assert data_path(scheduled, "s3://lake/in") == "s3://lake/in/*"
    assert data_path(scheduled.with_(bucket="b"), "/in") == "/in/*"
    assert data_path(scheduled.with_(bucket="b", object_key="k/x.csv"), "/in") == "s3://b/k/x.csv"


def test_fallback_takes_the_first_that_exists(spark, tmp_path):
    put(tmp_path / "c.csv", CUSTOMERS.format(s=","))
    paths = [(f"{tmp_path}/*.dat", "dat"), (f"{tmp_path}/*.csv", "csv")]
    assert read_first_found(spark, paths).count() == 2
    put(tmp_path / "c.dat", CUSTOMERS.format(s="\t") + "3\tCy\tc@example.com\n")
    assert read_first_found(spark, paths).count() == 3


def test_fallback_raises_when_nothing_exists_and_on_other_errors(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_first_found(spark, [(f"{tmp_path}/*.dat", "dat"), (f"{tmp_path}/*.csv", "csv")])
    with pytest.raises(ValueError):
        read_first_found(spark, [("/x", "xml")])
    put(tmp_path / "empty.parquet", "")
    put(tmp_path / "c.csv", CUSTOMERS.format(s=","))
    with pytest.raises(Exception, match="(?i)parquet"):
        read_first_found(spark, [(f"{tmp_path}/*.parquet", "parquet"), (f"{tmp_path}/*.csv", "csv")]).collect()


def test_fixture_is_for_the_local_environment(spark, tmp_path):
    put(tmp_path / "c.dat", CUSTOMERS.format(s="\t"))
    assert read_fixture(spark, JobConfig("j"), str(tmp_path), "c.dat").count() == 2
    with pytest.raises(FileNotFoundError):
        read_fixture(spark, JobConfig("j"), str(tmp_path), "d.dat")
    with pytest.raises(RuntimeError):
        read_fixture(spark, JobConfig("j", env="dev"), str(tmp_path), "c.dat")


def test_views_and_table_descriptions(spark):
    df = spark.createDataFrame([("a", 100), ("b", 150), ("c", 200)], "product string, price bigint")
    assert query_view(spark, df, "prices", "SELECT product FROM prices WHERE price > 120").count() == 2
    assert read_table(spark, "prices", ["price"]).columns == ["price"]
    assert table_info(spark, "prices") == {
        "table_name": "prices",
        "column_count": 2,
        "columns": [{"name": "product", "type": "string"}, {"name": "price", "type": "bigint"}],
    }
    missing = table_info(spark, "no_such_table")
    assert set(missing) == {"table_name", "error"} and "no_such_table" in missing["error"]
    rows = table_columns(spark, ["prices", "no_such_table"]).collect()
    assert [(r["table_name"], r["position"], r["error"] is None) for r in rows] == [
        ("prices", 1, True), ("prices", 2, True), ("no_such_table", None, False),
    ]


def parsed(spark, *responses):
    rows = parse_response(pages_from_responses(spark, list(responses))).collect()
    return [(r["id"], r["name"], None if r["price"] is None else str(r["price"])) for r in rows]


def test_bad_fields_become_null_and_leave_their_neighbours(spark):
    items = [
        '{"id":1,"name":"a","price":0.125}', '{"id":1,"name":"a","price":"3.5"}', '{"id":"2","name":"a","price":1}',
        '{"id":3.0,"name":"a","price":1}', '{"id":4,"name":7,"price":1}', '{"id":5,"name":"a","price":"abc"}',
        '{"id":6,"name":"a","price":1e12}', '{"id":99999999999,"name":"a","price":1}', "null", "{}",
    ]
    assert parsed(spark, '{"data":[' + ",".join(items) + "]}") == [
        (1, "a", "0.13"), (1, "a", "3.50"), (None, "a", "1.00"), (None, "a", "1.00"), (4, "7", "1.00"),
        (5, "a", None), (6, "a", None), (None, "a", "1.00"), (None, None, None), (None, None, None),
    ]


def test_responses_without_items_give_no_rows(spark):
    assert parsed(spark, "nope", "{}", '{"data":null}', '{"data":[]}', '{"items":[{"id":1}]}') == []


def response(run, page, size):
    return json.dumps({"data": [{"id": page * 1000 + i, "name": f"r{run}"} for i in range(size)]})


def fetched(sizes, page_size):
    """What a client would take over, asking page by page."""
    taken, page = [], 1
    while sizes.get(page):
        taken.append(page)
        if sizes[page] < page_size:
            break
        page += 1
    return taken


def test_two_pages_then_short(spark):
    pages = pages_from_responses(spark, [response(0, 1, 100), response(0, 2, 50), response(0, 3, 100)])
    assert parse_response(assemble_pages(pages)).count() == 150


@pytest.mark.parametrize("sizes", [{}, {2: 3}, {1: 0, 2: 3}, {1: 3, 2: 3}, {1: 3, 3: 3}, {1: 3, 2: 4, 3: 1, 4: 3}, {0: 3, 1: 3}])
def test_one_run_stops_like_a_client(spark, sizes):
    df = spark.createDataFrame([(p, response(0, p, n)) for p, n in sizes.items()], "page int, response string")
    kept = {r["page"] for r in assemble_pages(df, page_size=3).collect() if sizes[r["page"]]}
    assert kept == set(fetched(sizes, 3))


def test_many_runs_against_brute_force(spark):
    rng = random.Random(5)
    runs = {
        run: {p: rng.choice([3, 3, 3, 3, 4, 1, 0]) for p in range(1, 9) if rng.random() < 0.9} for run in range(40)
    }
    runs[40] = {p: 3 for p in range(1, 400)}
    rows = [(run, p, response(run, p, n)) for run, sizes in runs.items() for p, n in sizes.items()]
    df = spark.createDataFrame(rows, "run int, page int, response string").repartition(5)
    out = parse_response(assemble_pages(df, page_size=3, run=("run",)), keep=["run", "page"])
    got = {(r["run"], r["page"]): r["n"] for r in out.groupBy("run", "page").agg(F.count("*").alias("n")).collect()}
    assert got == {(run, p): sizes[p] for run, sizes in runs.items() for p in fetched(sizes, 3)}


def test_whole_documents(spark, tmp_path):
    document = {"data": [{"id": i, "name": f"n{i}", "price": i + 0.5} for i in range(3)], "pagination": {"page": 1}}
    put(tmp_path / "p.json", json.dumps(document, indent=2))
    assert sorted(r["id"] for r in parse_response(response_files(spark, str(tmp_path / "p.json"))).collect()) == [0, 1, 2]
