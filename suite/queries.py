"""One function `(spark, sf_dir) -> DataFrame` per registered query; each runs over its whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.config import ExportRequest, JobConfig
from lakejobs.functions import cleaning
from lakejobs.functions.categories import age_group, categorize_amount
from lakejobs.functions.json_cells import record_cell
from lakejobs.functions.metadata import add_processing_metadata
from lakejobs.operators.bounded import BroadcastLimit
from lakejobs.operators import batching, ledger, notifications, quality, routing, selection
from lakejobs.plans.customers import CustomersJob, clean_customers
from lakejobs.plans.export import export_rows
from lakejobs.plans.products import ProductsJob, enrich_products
from lakejobs.session import fresh_path, stage
from lakejobs.sinks.tables import overwrite_partitions, preview, table_of_key, write_table
from lakejobs.sources.api_pages import assemble_pages, parse_response
from lakejobs.sources.catalog import query_view, read_table, table_columns
from lakejobs.sources.files import RESCUED, data_path, format_of_key, read_files, read_first_found
from lakejobs.streaming.dispatch import dispatch_stream
from lakejobs.streaming.ingest import ingest_new_files, run_on_new_files, stream_declared, stream_files
from suite import inputs
from suite.inputs import AS_OF, JOB, RUN_ID, RUN_TIME, table

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]
SCHEDULED = JobConfig("suite", "run-1", env="dev")


def _unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


# Sources


def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return read_files(spark, f"{sf}/lineitem.parquet", "parquet")


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_files(spark, path, "csv").withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def scan_dat(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "dat")
    table(spark, sf, "part").write.option("header", True).option("sep", "\t").csv(path)
    return read_files(spark, path, "DAT").withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def scan_json(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "json")
    table(spark, sf, "conversations").write.json(path)
    return read_files(spark, path, "json").select("conv_id", "turn", "role", "text")


def scan_glob(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "glob")
    table(spark, sf, "orders").repartition(4).write.parquet(path)
    return read_files(spark, data_path(SCHEDULED, path, "*.parquet"), "parquet")


def scan_fallback(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "fallback")
    writer = inputs.customers(spark, sf).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    found = read_first_found(spark, [(data_path(SCHEDULED, path, "*.dat"), "dat"), (f"{path}/*.csv", "csv")])
    return found.select("customer_id", "first_name", "email")


def detect_format(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "pages").select("page_id", F.expr(inputs.FORMAT_KEY).alias("object_key"))
    return keys.withColumn("file_format", format_of_key(F.col("object_key")))


def pages_assemble(spark: SparkSession, sf: str) -> DataFrame:
    pages = inputs.fetch_runs(spark, sf)
    return parse_response(assemble_pages(pages, page_size=3, run=("run",)), keep=["run", "page"])


def pages_assemble_single(spark: SparkSession, sf: str) -> DataFrame:
    """One run over all pages, which ends before the missing one."""
    pages = inputs.product_pages(spark, sf)
    found = assemble_pages(pages.filter("page <> 7"), page_size=90)
    return parse_response(found, keep=["page"])


def parse_products(spark: SparkSession, sf: str) -> DataFrame:
    return parse_response(inputs.part_responses(spark, sf))


def table_info(spark: SparkSession, sf: str) -> DataFrame:
    for name in TABLES:
        table(spark, sf, name).createOrReplaceTempView(name)
    return table_columns(spark, TABLES).select("table_name", "column_count", "position", "name", "type")


def sql_view_filter(spark: SparkSession, sf: str) -> DataFrame:
    sql = "SELECT event_id, event_type, value FROM suite_events WHERE value > 120"
    return query_view(spark, table(spark, sf, "events"), "suite_events", sql)


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    sink, checkpoint = fresh_path(spark, "ingested"), fresh_path(spark, "ingest-checkpoint")
    schema = table(spark, sf, "events").schema
    ingest_new_files(stream_files(spark, sf, schema, pattern="events.parquet"), sink, checkpoint, timeout=600)
    return spark.read.parquet(sink)


# Sinks


def write_table_twice(spark: SparkSession, sf: str) -> DataFrame:
    name, path = _unique("written"), fresh_path(spark, "table")
    write_table(table(spark, sf, "customer"), name, path=path)
    write_table(table(spark, sf, "orders"), name, path=path)
    return read_table(spark, name)


def write_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by status; then those of one status come again with other totals, in columns of another order."""
    name, path = _unique("written"), fresh_path(spark, "table")
    orders = table(spark, sf, "orders")
    write_table(orders, name, partition_by=["o_orderstatus"], path=path, options={"compression": "zstd"})
    again = orders.filter("o_orderstatus = 'F' AND o_orderkey % 2 = 0").withColumn("o_totalprice", -F.col("o_totalprice"))
    overwrite_partitions(again.select(*reversed(orders.columns)), name)
    return read_table(spark, name).select(*orders.columns)


def preview_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return preview(orders, 10, ["o_orderkey"])


def table_from_key(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "pages").select("page_id", F.expr(inputs.TABLE_KEY).alias("object_key"))
    return keys.withColumn("table_name", table_of_key(F.col("object_key"), "prod"))


def _sender():
    """A receiver that reads every payload and rejects each fourth batch."""

    def send(payload: str) -> None:
        import json

        if json.loads(payload)["batch_number"] % 4 == 0:
            raise RuntimeError("rejected")

    return send


def _delivered(spark: SparkSession, sf: str) -> DataFrame:
    batched = batching.batch_records(table(spark, sf, "events"), ["event_id"])
    return batching.deliver_batches(batching.batch_payloads(batched), _sender())


def deliver_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _delivered(spark, sf)


def deliver_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """The second run of an export, the first of which had each fourth batch rejected; no other batch may come again."""

    def only_missing(payload: str) -> None:
        import json

        if json.loads(payload)["batch_number"] % 4:
            raise RuntimeError("sent twice")

    folder = fresh_path(spark, "ledger")
    folder = folder if "://" in folder else f"file://{folder}"
    payloads = stage(batching.batch_payloads(batching.batch_records(table(spark, sf, "events"), ["event_id"])), "payloads")
    ledger.deliver_resumable(payloads, _sender(), folder, "export-1", batching.ONCE)
    ledger.close_ledger(spark, folder, "export-1")
    return ledger.deliver_resumable(payloads, only_missing, folder, "export-1", batching.Retry(2, 0.0))


def delivery_summary(spark: SparkSession, sf: str) -> DataFrame:
    return batching.delivery_summary(_delivered(spark, sf))


class _DerivedCustomers(CustomersJob):
    def extract(self) -> DataFrame:
        return inputs.customers(self.spark, self.base_path)


def _customer_files(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Comma-separated files; some ids are larger than an integer, some are no numbers."""
    texts = rows.withColumn("customer_id", F.expr(inputs.CUSTOMER_ID)).select(inputs.CUSTOMER_COLUMNS)
    writer = texts.write.mode(mode).option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("processed_timestamp", F.col("processed_timestamp").cast("timestamp_ntz"))


def _job_on_files(spark: SparkSession, sf: str) -> CustomersJob:
    path = fresh_path(spark, "customer-files")
    _customer_files(inputs.customers(spark, sf), path)
    config = JobConfig(JOB, RUN_ID, env="dev", log_level="ERROR", enable_report=False)
    job = CustomersJob(config, spark, base_path=path, table_path=fresh_path(spark, "customers"), run_time=inputs.run_time())
    # Each run has tables of its own.
    job.entity = _unique("customers")
    job.run()
    return job


def customers_files(spark: SparkSession, sf: str) -> DataFrame:
    """The table that the whole customer job writes from files."""
    return _stamped(spark.table(_job_on_files(spark, sf).table))


def customers_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """What the same job sets aside, with the text that is no number."""
    rows = spark.table(_job_on_files(spark, sf).quarantine_table)
    return rows.select(F.col(RESCUED)["customer_id"].alias("rescued_id"), "customer_id", "first_name", "last_name", "email", "phone", F.size(RESCUED).alias("cells"))


def customers_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of the job over a folder of files that grows between the first two."""
    path, sink, checkpoint = (fresh_path(spark, x) for x in ("customer-files", "customers", "customers-checkpoint"))
    config = JobConfig(JOB, RUN_ID, env="dev", log_level="ERROR", enable_report=False)
    rows = inputs.customers(spark, sf)
    for part in (rows.filter("customer_id % 3 = 0").coalesce(1), rows.filter("customer_id % 3 > 0").coalesce(1), None):
        if part is not None:
            _customer_files(part, path, "append")
        job = CustomersJob(config, spark, run_time=inputs.run_time())
        run_on_new_files(job, stream_declared(spark, path, pattern="*.csv"), sink, checkpoint, timeout=600)
    return _stamped(spark.read.option("basePath", sink).parquet(sink)).withColumn("batch_id", F.col("batch_id").cast("long"))


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    reports = _unique("job_runs")
    job = _DerivedCustomers(
        JobConfig(JOB, RUN_ID, env="dev", log_level="ERROR"),
        spark,
        base_path=sf,
        table_path=fresh_path(spark, "customers"),
        report_table=reports,
        report_path=fresh_path(spark, "reports"),
        run_time=inputs.run_time(),
    )
    job.run()
    return spark.table(reports).select(
        "event_type", "environment", "job_name", "job_run_id", "trigger_type", "records_processed",
        F.array_join("output_paths", ",").alias("output_paths"), "error",
    )


def run_report_failure(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a job whose quality gate fails: most e-mails are taken away."""

    class Poor(_DerivedCustomers):
        def extract(self) -> DataFrame:
            return super().extract().withColumn("email", F.when(F.col("customer_id") % 10 == 0, F.col("email")))

    reports = _unique("job_runs")
    config = JobConfig(JOB, RUN_ID, env="dev", log_level="ERROR")
    job = Poor(config, spark, base_path=sf, report_table=reports, report_path=fresh_path(spark, "reports"))
    job.logger.disabled = True
    try:
        job.run()
    except RuntimeError:
        job.logger.disabled = False
    return spark.table(reports).select(
        "event_type", "job_name", "job_run_id", "records_processed", F.array_join("output_paths", ",").alias("output_paths"), "error"
    )


def products_job(spark: SparkSession, sf: str) -> DataFrame:
    """The table that the whole product job writes."""
    job = ProductsJob(
        JobConfig(JOB, RUN_ID, env="dev", log_level="ERROR", enable_report=False),
        spark,
        pages=lambda: inputs.product_pages(spark, sf),
        page_size=1,
        table_path=fresh_path(spark, "products"),
        run_time=inputs.run_time(),
    )
    # Each run has a table of its own.
    job.entity = _unique("products")
    job.run()
    stamp = F.col("processed_timestamp").cast("timestamp_ntz").alias("processed_timestamp")
    written = spark.table(job.table)
    return written.select(*[stamp if name == "processed_timestamp" else F.col(name) for name in written.columns])


# Column functions


def clean_email(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "customer").select("c_custkey", F.expr(inputs.EMAIL_KINDS).alias("raw"))
    return raw.withColumn("email", cleaning.clean_email(F.col("raw")))


def standardize_phone(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "customer").select("c_custkey", F.expr(inputs.PHONE).alias("raw"))
    return raw.withColumn("phone", cleaning.standardize_phone(F.col("raw")))


def standardize_name(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", cleaning.standardize_name(F.col("text")).alias("name"))


def full_name(spark: SparkSession, sf: str) -> DataFrame:
    name = cleaning.full_name(F.col("first_name"), F.col("last_name"))
    return inputs.customers(spark, sf).select("customer_id", name.alias("full_name"))


def categorize(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.expr(inputs.PRODUCT_PRICE)
    return table(spark, sf, "events").select(
        "event_id", categorize_amount(amount).alias("category"), categorize_amount(amount, 50, 250).alias("custom")
    )


def when_category(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", age_group(F.col("p_size")).alias("category"))
    return parts.filter(F.col("category") == "adult")


def add_metadata(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.lit(RUN_TIME).cast("timestamp_ntz")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return add_processing_metadata(orders, JOB, RUN_ID, stamp)


def json_cells(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    props, kind = record_cell(events, "props"), record_cell(events, "event_type")
    return events.select(
        "event_id",
        F.try_variant_get(props, "$.k", "int").alias("k"),
        F.try_variant_get(kind, "$", "string").alias("event_type"),
    )


# Jobs and quality


def _clean_customers(spark: SparkSession, sf: str) -> DataFrame:
    return clean_customers(inputs.customers(spark, sf))


def customers_silver(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.lit(RUN_TIME).cast("timestamp_ntz")
    return add_processing_metadata(_clean_customers(spark, sf), JOB, RUN_ID, stamp)


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return parse_response(inputs.product_pages(spark, sf))


def products_bronze(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.lit(RUN_TIME).cast("timestamp_ntz")
    return add_processing_metadata(enrich_products(_products(spark, sf)), JOB, RUN_ID, stamp)


def group_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def quality_base(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_base(inputs.customers(spark, sf), ["customer_id", "first_name", "email"])


def quality_customers(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_customers(_clean_customers(spark, sf))


def quality_products(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_products(_products(spark, sf))


# Export


def _export_dates(name: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return selection.on_dates(table(spark, sf, "events"), name, AS_OF, "ts")

    return query


def export_select(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "events").createOrReplaceTempView("suite_lake_events")
    rows = read_table(spark, "suite_lake_events", ["event_id", "ts", "event_type", "value"])
    dated = selection.on_dates(rows, "last_week", AS_OF, "ts")
    return selection.matching(dated, "value > 200 OR event_type = 'purchase'")


def export_limit(spark: SparkSession, sf: str) -> DataFrame:
    rows = selection.on_dates(table(spark, sf, "events"), "last_week", AS_OF, "ts")
    return selection.capped(rows.select("event_id", "value"), ["event_id"], 500, 10_000)


def export_limit_text(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows by a text with a common stem, many of them equal."""
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("lake://returns/"), "l_returnflag", F.lit("/"), "l_linestatus").alias("object_key"), "l_orderkey", "l_linenumber"
    )
    return selection.capped(rows, ["object_key", "l_orderkey", "l_linenumber"], 2_000)


def export_limit_large(spark: SparkSession, sf: str) -> DataFrame:
    """A limit of millions, more than any task should sort; ties in the leading column, which is text."""
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    return selection.capped(rows, ["l_returnflag", "l_orderkey", "l_linenumber"], 150_000)


def batch_records(spark: SparkSession, sf: str) -> DataFrame:
    return batching.batch_records(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"]).select(
        "o_orderkey", "batch_number", "total_batches"
    )


def batch_payloads(spark: SparkSession, sf: str) -> DataFrame:
    return _sent(batching.batch_payloads(batching.batch_records(table(spark, sf, "orders"), ["o_orderkey"])))


def batch_payloads_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The same payloads, from ranges of whole batches."""
    return _sent(batching.ordered_payloads(table(spark, sf, "orders"), ["o_orderkey"]))


def _sent(payloads: DataFrame) -> DataFrame:
    schema = "batch_number bigint, total_batches bigint, records array<struct<o_orderkey:string,o_totalprice:string>>"
    parsed = payloads.select("records", F.from_json("payload", schema).alias("sent"))
    keys = F.col("sent.records.o_orderkey").cast("array<bigint>")
    return parsed.select(
        F.col("sent.batch_number").alias("batch_number"),
        F.col("sent.total_batches").alias("total_batches"),
        "records",
        F.size("sent.records").alias("sent_records"),
        F.array_min(keys).alias("min_key"),
        F.array_max(keys).alias("max_key"),
    )


def lake_export(spark: SparkSession, sf: str) -> DataFrame:
    request = ExportRequest.scheduled("events", "last_week", "value > 2 OR user_id = 1", as_of=AS_OF)
    return export_rows(table(spark, sf, "events"), request, _sender(), ["event_id"], "ts")


def lake_export_capped(spark: SparkSession, sf: str) -> DataFrame:
    request = ExportRequest.scheduled("events", "last_week", "value > 2 OR user_id = 1", as_of=AS_OF, max_records=750)
    return export_rows(table(spark, sf, "events"), request, _sender(), ["event_id"], "ts")


# Notifications


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.messages(table(spark, sf, "events"))


def _routes(spark: SparkSession) -> DataFrame:
    return routing.parse_route_specs(spark.range(1).select(F.lit(inputs.ROUTE_SPEC).alias("spec")))


def events_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return notifications.unwrap_envelopes(inputs.envelopes(table(spark, sf, "events")), keys=("event_id",))


def events_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return notifications.normalize_messages(_messages(spark, sf), keys=("event_id",))


def event_rule_match(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _messages(spark, sf).select("event_id", F.try_parse_json("message").alias("message"))
    matches = notifications.match_rule(F.col("message"), "lake-1", "customers/", "7.csv")
    wide = notifications.match_rule(F.col("message"), "lake-0")
    return parsed.select("event_id", matches.alias("matches"), wide.alias("matches_bucket"))


def _rule_targets(spark: SparkSession, sf: str, limit: BroadcastLimit) -> DataFrame:
    """A rule per bucket and kind of event, and one per bucket for keys with a certain ending."""
    events = table(spark, sf, "events")
    bucket = F.expr(inputs.BUCKET)
    by_kind = events.select(
        F.concat(bucket, F.lit(":"), "event_type").alias("rule"),
        bucket.alias("bucket"),
        F.concat(F.lit("customers/"), "event_type", F.lit("/")).alias("prefix"),
        F.lit(".csv").alias("suffix"),
    )
    by_ending = events.select(
        bucket.alias("rule"), bucket.alias("bucket"), F.lit("").alias("prefix"), F.lit("1.csv").alias("suffix")
    )
    rules = by_kind.union(by_ending).distinct()
    targets = notifications.rule_targets(_messages(spark, sf), rules, "test", keys=("event_id",), limit=limit)
    return targets.withColumn("arguments", F.to_json("arguments"))


def event_rule_targets(spark: SparkSession, sf: str) -> DataFrame:
    return _rule_targets(spark, sf, BroadcastLimit())


def event_rule_targets_many(spark: SparkSession, sf: str) -> DataFrame:
    """The same on the way for rules that are too many to be broadcast."""
    return _rule_targets(spark, sf, BroadcastLimit(rows=3))


def route_spec_parse(spark: SparkSession, sf: str) -> DataFrame:
    specs = table(spark, sf, "customer").select("c_custkey", F.expr(inputs.CUSTOMER_SPEC).alias("spec"))
    return routing.parse_route_specs(specs, keys=("c_custkey",))


def page_routes(pages: DataFrame) -> DataFrame:
    """A route per host and, for hosts with a subdomain, per host and language; of https pages."""
    parts = pages.filter(F.startswith(F.col("url"), F.lit("https:"))).select(
        F.split(F.expr(inputs.URL_KEY), "/").alias("parts")
    )
    host, language = F.col("parts")[0], F.col("parts")[1]
    by_host = parts.select(F.concat(host, F.lit("/")).alias("prefix"), F.concat(F.lit("h-"), host).alias("job"))
    by_language = parts.filter(host.rlike("^(m|blog)[.]")).select(
        F.concat(host, F.lit("/"), language, F.lit("/")).alias("prefix"), F.concat(F.lit("l-"), language).alias("job")
    )
    return by_host.union(by_language).distinct()


def _page_keys(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.expr(inputs.URL_KEY).alias("object_key"))


def route_longest_prefix(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return routing.route_longest_prefix(_page_keys(pages), page_routes(pages))


def route_many(spark: SparkSession, sf: str) -> DataFrame:
    """A route per page address, more than are broadcast; some addresses have two jobs."""
    pages = table(spark, sf, "pages")
    keys = _page_keys(pages)
    named = keys.select(F.col("object_key").alias("prefix"), F.concat(F.lit("j"), F.col("page_id") % 3).alias("job"))
    routes = named.union(page_routes(pages))
    return routing.route_longest_prefix(keys, routes, limit=BroadcastLimit(rows=20))


def route_default(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "pages").select("page_id", F.expr(inputs.FOLDER_KEY).alias("object_key"))
    return keys.withColumn("job_name", routing.default_route(F.col("object_key"), "test"))


def _plan_columns(plan: DataFrame) -> DataFrame:
    return plan.withColumn("arguments", F.to_json("arguments")).select(
        "event_id", "event_no", "bucket", "object_key", "event_name", "job_name", "arguments", "status", "reason"
    )


def dispatch_plan(spark: SparkSession, sf: str) -> DataFrame:
    plan = notifications.dispatch_plan(_messages(spark, sf), _routes(spark), "test", keys=("event_id",))
    return _plan_columns(plan)


def dispatch_summary(spark: SparkSession, sf: str) -> DataFrame:
    plan = notifications.dispatch_plan(_messages(spark, sf), _routes(spark), "test", keys=("event_id",))
    return notifications.dispatch_summary(plan, ("event_id",))


def envelope_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    envelopes = inputs.envelopes(table(spark, sf, "events"))
    plan = notifications.dispatch_envelopes(envelopes, _routes(spark), "test", keys=("event_id",))
    return notifications.dispatch_summary(plan, ("event_id", "record_no"))


def stream_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    sink, checkpoint = fresh_path(spark, "dispatched"), fresh_path(spark, "dispatch-checkpoint")
    events = stream_files(spark, sf, table(spark, sf, "events").schema, pattern="events.parquet")
    dispatch_stream(
        inputs.messages(events), sink, checkpoint, _routes(spark), "test", keys=("event_id",), timeout=600
    )
    return _plan_columns(spark.read.parquet(sink))


def stream_dispatch_once(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs over a folder of messages, in which all of them come a second time and a third."""
    source, sink, checkpoint = (fresh_path(spark, x) for x in ("messages", "dispatched", "dispatch-checkpoint"))
    events = table(spark, sf, "events")
    sent = inputs.messages(events).join(events.select("event_id", F.col("ts").cast("timestamp").alias("arrived")), "event_id")
    for part in (sent.filter("event_id % 3 = 0"), sent, sent):
        part.write.mode("append").parquet(source)
        stream = stream_files(spark, source, part.schema, pattern="*.parquet")
        dispatch_stream(stream, sink, checkpoint, _routes(spark), "test", keys=("event_id",), timeout=600, once_within="60 days")
    return _plan_columns(spark.read.parquet(sink))


QUERIES = {
    "scan_csv": scan_csv,
    "scan_dat": scan_dat,
    "scan_json": scan_json,
    "scan_parquet": scan_parquet,
    "scan_glob": scan_glob,
    "scan_fallback": scan_fallback,
    "detect_format": detect_format,
    "pages_assemble": pages_assemble,
    "pages_assemble_single": pages_assemble_single,
    "parse_products": parse_products,
    "table_info": table_info,
    "sql_view_filter": sql_view_filter,
    "stream_ingest": stream_ingest,
    "write_table": write_table_twice,
    "write_partitions": write_partitions,
    "preview": preview_orders,
    "table_from_key": table_from_key,
    "deliver_batches": deliver_batches,
    "deliver_resumed": deliver_resumed,
    "delivery_summary": delivery_summary,
    "run_report": run_report,
    "run_report_failure": run_report_failure,
    "products_job": products_job,
    "clean_email": clean_email,
    "standardize_phone": standardize_phone,
    "standardize_name": standardize_name,
    "full_name": full_name,
    "categorize_amount": categorize,
    "when_category": when_category,
    "add_metadata": add_metadata,
    "json_cells": json_cells,
    "customers_silver": customers_silver,
    "customers_files": customers_files,
    "customers_rescued": customers_rescued,
    "customers_incremental": customers_incremental,
    "products_bronze": products_bronze,
    "group_count": group_count,
    "quality_base": quality_base,
    "quality_customers": quality_customers,
    "quality_products": quality_products,
    "export_today": _export_dates("today"),
    "export_yesterday": _export_dates("yesterday"),
    "export_last_week": _export_dates("last_week"),
    "export_select": export_select,
    "export_limit": export_limit,
    "export_limit_large": export_limit_large,
    "export_limit_text": export_limit_text,
    "batch_records": batch_records,
    "batch_payloads": batch_payloads,
    "batch_payloads_ordered": batch_payloads_ordered,
    "lake_export": lake_export,
    "lake_export_capped": lake_export_capped,
    "events_envelope": events_envelope,
    "events_normalize": events_normalize,
    "event_rule_match": event_rule_match,
    "event_rule_targets": event_rule_targets,
    "event_rule_targets_many": event_rule_targets_many,
    "route_spec_parse": route_spec_parse,
    "route_longest_prefix": route_longest_prefix,
    "route_many": route_many,
    "route_default": route_default,
    "dispatch_plan": dispatch_plan,
    "dispatch_summary": dispatch_summary,
    "envelope_dispatch": envelope_dispatch,
    "stream_dispatch": stream_dispatch,
    "stream_dispatch_once": stream_dispatch_once,
}
