"""Rescued values, jobs over new files, and deliveries that are taken up again."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.config import JobConfig
from lakejobs.operators.batching import Retry, batch_payloads, batch_records
from lakejobs.operators.ledger import acknowledged, close_ledger, deliver_resumable
from lakejobs.plans.customers import CustomersJob
from lakejobs.schemas import CUSTOMER
from lakejobs.session import fresh_path, stage
from lakejobs.sources.files import RESCUED, read_declared, typed_by_name
from lakejobs.streaming.ingest import run_on_new_files, stream_declared

HEADER = "customer_id,first_name,last_name,email,phone"


def write(folder, name, *lines, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_cells_that_do_not_fit_are_kept_as_text(spark, tmp_path):
    write(tmp_path, "a.csv", "C001,a,b,a@x.org,1", "3000000000,b,,b@x.org,", "7,c,c,c@x.org,2", ",d,d,d@x.org,3", "1.5,e,e,,")
    rows = read_declared(spark, str(tmp_path), "csv", CUSTOMER, RESCUED).collect()
    assert [(r.customer_id, r[RESCUED]) for r in rows] == [
        (None, {"customer_id": "C001"}), (3000000000, None), (7, None), (None, None), (None, {"customer_id": "1.5"}),
    ]
    assert rows[0].first_name == "a" and rows[0].phone == "1"


def test_several_cells_of_a_row_and_columns_of_odd_names(spark):
    declared = T.StructType([T.StructField("a.b", T.IntegerType()), T.StructField("d", T.DateType()), T.StructField("t", T.StringType())])
    texts = spark.createDataFrame([("x", "2024-13-01", "t", "more"), ("1", "2024-01-01", None, None)], "`a.b` string, d string, t string, extra string")
    first, second = typed_by_name(texts, declared, RESCUED).collect()
    assert first[RESCUED] == {"a.b": "x", "d": "2024-13-01"} and first["extra"] == "more"
    assert second[RESCUED] is None and second["a.b"] == 1
    assert RESCUED not in typed_by_name(texts, declared).columns


def _job(spark, tmp_path, **rest):
    job = CustomersJob(JobConfig("j", "r", env="dev", log_level="ERROR", enable_report=False), spark, table_path=str(tmp_path / "out"), **rest)
    job.entity = f"customers_{tmp_path.name.replace('-', '_')}"
    return job


def test_no_id_is_lost(spark, tmp_path):
    write(tmp_path / "in", "a.csv", "C001,a,b,a@x.org,1", "3000000000,b,,b@x.org,", "7,c,c,c@x.org,2")
    job = _job(spark, tmp_path, base_path=str(tmp_path / "in"))
    assert job.run()
    assert sorted(r.customer_id for r in spark.table(job.table).collect()) == [7, 3000000000]
    (odd,) = spark.table(job.quarantine_table).collect()
    assert odd[RESCUED] == {"customer_id": "C001"} and odd.email == "a@x.org" and odd.job_run_id == "r"


def test_files_in_which_nothing_fits_fail_the_job(spark, tmp_path):
    write(tmp_path / "in", "a.csv", "C001,a,b,a@x.org,1")
    job = _job(spark, tmp_path, base_path=str(tmp_path / "in"))
    with pytest.raises(RuntimeError, match="no row fits"):
        job.run()
    assert spark.table(job.quarantine_table).count() == 1
    inferred = _job(spark, tmp_path, base_path=str(tmp_path / "in"), infer=True)
    assert inferred.run() and spark.table(inferred.table).first().customer_id == "C001"


def test_a_job_takes_each_file_once(spark, tmp_path):
    source, sink, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        job = _job(spark, tmp_path)
        run_on_new_files(job, stream_declared(spark, str(source), pattern="*.csv"), sink, checkpoint, timeout=120)
        rows = spark.read.parquet(sink).select("customer_id", F.col("batch_id").cast("int")).collect()
        return sorted(map(tuple, rows))

    write(source, "a.csv", "1,a,b,a@x.org,1", "X,a,b,a@x.org,1")
    assert run() == [(1, 0)] and run() == [(1, 0)]
    write(source, "b.csv", "2,a,b,b@x.org,1")
    assert run() == [(1, 0), (2, 1)]
    (odd,) = spark.read.parquet(f"{sink}-quarantine").collect()
    assert odd[RESCUED] == {"customer_id": "X"} and odd.batch_id == 0


def test_files_turned_down_by_the_gate_come_again(spark, tmp_path):
    source, sink, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    write(source, "bad.csv", "1,a,b,none,1", "2,a,b,none,1")
    stream = stream_declared(spark, str(source), pattern="*.csv")
    with pytest.raises(Exception, match="gate"):
        run_on_new_files(_job(spark, tmp_path), stream, sink, checkpoint, timeout=120)
    assert not os.path.exists(sink)

    class Lenient(CustomersJob):
        def gate(self, df):
            return super().gate(df).withColumn("passed", F.lit(True))

    job = Lenient(JobConfig("j", "r", env="dev", log_level="ERROR", enable_report=False), spark)
    run_on_new_files(job, stream_declared(spark, str(source), pattern="*.csv"), sink, checkpoint, timeout=120)
    assert spark.read.parquet(sink).count() == 2


def _payloads(spark, n):
    rows = spark.range(n).withColumnRenamed("id", "k")
    return stage(batch_payloads(batch_records(rows, ["k"], batch_size=1)), "payloads")


def test_a_killed_export_sends_no_acknowledged_batch_twice(spark, tmp_path):
    sent, ledger = tmp_path / "sent", f"file://{tmp_path}/ledger"
    payloads, folder = _payloads(spark, 12).coalesce(1), str(sent)
    os.makedirs(folder)

    def receive(payload, dies_at=None):
        number = json.loads(payload)["batch_number"]
        if number == dies_at:
            os._exit(1)
        with open(f"{folder}/{number}", "a") as out:
            out.write("x")

    with pytest.raises(Exception):  # noqa: B017, PT011
        deliver_resumable(payloads, lambda p: receive(p, 7), ledger, "e")
    done = {r.batch_number for r in acknowledged(spark, ledger, "e").collect()}
    assert done and done == {int(x) for x in os.listdir(folder)}
    rows = deliver_resumable(payloads, receive, ledger, "e").collect()
    assert {r.batch_number for r in rows if r.resumed} == done and all(r.ok for r in rows) and len(rows) == 12
    assert all((sent / str(i)).read_text() == "x" for i in range(1, 13)), "each batch came once"
    close_ledger(spark, ledger, "e")
    assert all(r.resumed for r in deliver_resumable(payloads, receive, ledger, "e").collect())
    other = deliver_resumable(payloads, receive, ledger, "another")
    assert not any(r.resumed for r in other.collect())


def test_batches_that_changed_are_sent_again(spark):
    ledger = f"file://{fresh_path(spark, 'ledger').removeprefix('file://')}"
    deliver_resumable(_payloads(spark, 4), lambda p: None, ledger, "e")
    changed = _payloads(spark, 4).withColumn("payload", F.when(F.col("batch_number") == 2, F.lit("{}")).otherwise(F.col("payload")))
    rows = {r.batch_number: r.resumed for r in deliver_resumable(changed, lambda p: None, ledger, "e").collect()}
    assert rows == {1: True, 2: False, 3: True, 4: True}


def test_attempts_and_waits(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr("lakejobs.operators.batching.time.sleep", waits.append)

    def fails(payload):
        calls.append(payload)
        raise ValueError("no" if len(calls) < 9 else "")

    assert Retry(5, 1.0, 2.0, 3.0).call(fails, "p") == "no" and waits == [1.0, 2.0, 3.0, 3.0] and len(calls) == 5

    def second(payload):
        calls.append(payload)
        if len(calls) < 7:
            raise ValueError

    assert Retry(3, 0.5).call(second, "p") is None and len(calls) == 7
