"""Object-created notifications: unwrap envelopes, normalise messages, plan the jobs they start.

A message is JSON text in one of four shapes. It is parsed once into a VARIANT, and every value is
read from that. All steps up to the route join work row by row, so nothing is shuffled.

Which shape a message has is decided by the presence of keys, also of keys that hold null:

1. `Records`: a list of object-store records;
2. `detail` holding `bucket`: an event-bus event;
3. `bucket` and `object_key`: flat;
4. anything else: the first present of several names for bucket and key.

The first shape that fits counts even if it yields nothing. A message whose parts have the wrong
type (a record that is no object, a null `detail`) yields nothing as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.operators.bounded import BroadcastLimit, salted_join
from lakejobs.operators.routing import DEFAULT_ENV, route_jobs
from lakejobs.session import stage

# Names, sources and texts of the notification format and of the dispatch results.
QUEUE_SOURCE = "aws:sns"
STORE_SOURCE = "aws:s3"
BUS_SOURCE = "aws.s3"
BUS_DETAIL_TYPE = "Object Created"
DEFAULT_EVENT_NAME = "ObjectCreated"
BUCKET_NAMES = ["bucketName", "bucket_name", "Bucket", "s3Bucket"]
KEY_NAMES = ["objectKey", "object_key", "key", "Key", "s3Key", "objectName"]
NO_EVENTS = "No S3 events found"
NO_JOB = "No matching Glue job"

EVENT_TYPE = "struct<bucket:string,object_key:string,event_name:string>"

# Everything the shapes look at, taken from a message in one step. A key that is absent gives NULL, a
# key that holds null gives a VARIANT null. `Bucket` and `Key` differ from `bucket` and `key` in case
# only and so need a struct of their own.
_TOP = "struct<{}>".format(
    ",".join(
        f"`{name}`:variant"
        for name in ["Records", "detail", "detail-type", "bucket", "event_name", "eventName"]
        + [name for name in BUCKET_NAMES + KEY_NAMES if name not in ("Bucket", "Key")]
    )
)
_CAPITALS = "struct<Bucket:variant,Key:variant>"
_BUS_EVENT = (
    "struct<source:string,`detail-type`:string,detail:struct<bucket:struct<name:string>,object:struct<key:string>>>"
)
_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"
_RECORDS = "array<struct<eventSource:string,eventName:variant,s3:variant>>"


def allow_repeated_keys(spark: SparkSession) -> None:
    """JSON text may repeat a key, and its last value counts; Spark refuses it unless the session allows it."""
    if spark.conf.get(_REPEATED_KEYS, "false") != "true":
        spark.conf.set(_REPEATED_KEYS, "true")


def _at(value: Column, path: str = "$", kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _is_object(value: Column) -> Column:
    return _at(value, "$", "struct<name:variant>").isNotNull()


def _is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _name(value: Column) -> Column:
    """The event name; the default stands in for a missing key, not for a null."""
    return F.when(value.isNull(), F.lit(DEFAULT_EVENT_NAME)).otherwise(_at(value))


def _event(bucket: Column, object_key: Column, event_name: Column) -> Column:
    return F.struct(bucket.alias("bucket"), object_key.alias("object_key"), event_name.alias("event_name"))


def _filled(event: Column) -> Column:
    """Bucket and key both there and not empty."""
    return _is_true((event["bucket"] != "") & (event["object_key"] != ""))


def _events(*events: Column) -> Column:
    return F.array(*events).cast(f"array<{EVENT_TYPE}>")


def _one_if_filled(event: Column) -> Column:
    return F.when(_filled(event), _events(event)).otherwise(_events())


def _is_broken(record: Column) -> Column:
    """A record no client could read: not an object, or with a part that should be an object and is not."""
    store = record["s3"]
    bucket, item = _at(store, "$.bucket", "variant"), _at(store, "$.object", "variant")
    has_bucket = _is_true(_at(bucket, "$.name") != "")
    broken_store = (
        (store.isNotNull() & ~_is_object(store))
        | (bucket.isNotNull() & ~_is_object(bucket))
        | (has_bucket & item.isNotNull() & ~_is_object(item))
    )
    return record.isNull() | (_is_true(record["eventSource"] == STORE_SOURCE) & broken_store)


def _store_event(record: Column) -> Column:
    """The event of a record, NULL for records of other sources."""
    event = _event(
        _at(record["s3"], "$.bucket.name"), _at(record["s3"], "$.object.key"), _name(record["eventName"])
    )
    return F.when(_is_true(record["eventSource"] == STORE_SOURCE), event)


def _shape_1(records: Column) -> Column:
    events = F.filter(F.transform(records, _store_event), _filled)
    readable = records.isNotNull() & ~F.exists(records, _is_broken)
    return F.when(readable, events.cast(f"array<{EVENT_TYPE}>")).otherwise(_events())


def _shape_2(top: Column) -> Column:
    detail = top["detail"]
    return _one_if_filled(
        _event(_at(detail, "$.bucket.name"), _at(detail, "$.object.key"), _name(top["detail-type"]))
    )


def _shape_3(top: Column) -> Column:
    return _events(_event(_at(top["bucket"]), _at(top["object_key"]), _name(top["event_name"])))


def _shape_4(top: Column, capitals: Column) -> Column:
    def first_present(names: list[str]) -> Column:
        return _at(F.coalesce(*[(capitals if name in ("Bucket", "Key") else top)[name] for name in names]))

    return _one_if_filled(_event(first_present(BUCKET_NAMES), first_present(KEY_NAMES), _name(top["eventName"])))


def _detail_decides(detail: Column) -> Column:
    """Whether `detail` keeps the later shapes out: it holds `bucket`, or nothing can be looked up in it."""
    kind = F.schema_of_variant(detail)
    holds = (
        F.when(_is_object(detail), _at(detail, "$.bucket", "variant").isNotNull())
        .when(kind == "STRING", F.contains(_at(detail), F.lit("bucket")))
        .when(F.startswith(kind, F.lit("ARRAY")), F.array_contains(_at(detail, "$", "array<string>"), "bucket"))
        .otherwise(F.lit(True))
    )
    return detail.isNotNull() & _is_true(holds)


def read_messages(messages: DataFrame, message: str = "message", keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows `(*keys, events, is_readable)`: every message with its array of events, empty when it has none.

    `is_readable` is false for text that is not JSON. Of a repeated key the last value counts. The steps
    are separate projections, so that each value is taken out once and used often.
    """
    allow_repeated_keys(messages.sparkSession)
    parsed = messages.select(*keys, F.try_parse_json(F.col(message)).alias("_message"))
    taken = parsed.select(
        *keys,
        F.col("_message").isNotNull().alias("is_readable"),
        _at(F.col("_message"), "$", _TOP).alias("_top"),
        _at(F.col("_message"), "$", _CAPITALS).alias("_capitals"),
        _at(F.col("_message"), "$.Records", _RECORDS).alias("_records"),
    )
    top = F.col("_top")
    events = (
        F.when(top.isNull(), _events())
        .when(top["Records"].isNotNull(), _shape_1(F.col("_records")))
        .when(_detail_decides(top["detail"]), _shape_2(top))
        .when(top["bucket"].isNotNull() & top["object_key"].isNotNull(), _shape_3(top))
        .otherwise(_shape_4(top, F.col("_capitals")))
    )
    return taken.select(*keys, events.alias("events"), "is_readable")


def unwrap_envelopes(envelopes: DataFrame, envelope: str = "envelope", keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows `(*keys, record_no, message)` for the queue records of each envelope.

    A record without message text comes out with a NULL message, which counts as an error later on. So
    does an envelope that is not JSON or whose `Records` is no list: it gives one row with neither number
    nor message. Records of other sources, and envelopes without any record, give none.
    """
    allow_repeated_keys(envelopes.sparkSession)
    parsed = envelopes.select(*keys, F.try_parse_json(F.col(envelope)).alias("_envelope"))
    listed = parsed.select(
        *keys,
        F.try_variant_get("_envelope", "$.Records", "array<variant>").alias("_records"),
        _is_true(_is_object(F.col("_envelope")) & _at(F.col("_envelope"), "$.Records", "variant").isNull()).alias("_none"),
    )
    records = listed.select(
        *keys,
        (F.col("_records").isNull() & ~F.col("_none")).alias("_unreadable"),
        F.posexplode_outer("_records").alias("_position", "_record"),
    )
    record = F.col("_record")
    sent = _at(record, "$.Sns.Message", "variant")
    text = F.when(F.schema_of_variant(sent) == "STRING", _at(sent))
    return records.filter(F.col("_unreadable") | (_at(record, "$.EventSource") == QUEUE_SOURCE)).select(
        *keys, (F.col("_position") + 1).cast("int").alias("record_no"), text.alias("message")
    )


def normalize_messages(messages: DataFrame, message: str = "message", keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows `(*keys, event_no, bucket, object_key, event_name)`, none for messages without events."""
    read = read_messages(messages, message, keys)
    # The outer form keeps Spark from testing the array for emptiness first, which would build it twice.
    exploded = read.select(*keys, F.posexplode_outer("events").alias("_position", "_event"))
    found = exploded.filter(F.col("_position").isNotNull())
    return found.select(*keys, (F.col("_position") + 1).cast("int").alias("event_no"), "_event.*")


def match_rule(message: Column, bucket: str | Column, prefix: str | Column = "", suffix: str | Column = "") -> Column:
    """Whether a parsed event-bus message is an object-created event of this bucket, key prefix and suffix."""
    wanted = [F.lit(value) if isinstance(value, str) else value for value in (bucket, prefix, suffix)]
    key = _at(message, "$.detail.object.key")
    matches = (
        (_at(message, "$.source") == BUS_SOURCE)
        & (_at(message, "$['detail-type']") == BUS_DETAIL_TYPE)
        & (_at(message, "$.detail.bucket.name") == wanted[0])
        & F.startswith(key, wanted[1])
        & F.endswith(key, wanted[2])
    )
    return _is_true(matches)


def rule_targets(
    messages: DataFrame,
    rules: DataFrame,
    env: str = DEFAULT_ENV,
    message: str = "message",
    keys: tuple[str, ...] = (),
    limit: BroadcastLimit = BroadcastLimit(),
) -> DataFrame:
    """Rows `(*keys, rule, bucket, object_key, arguments)`: every rule that an event-bus message fits.

    `rules` has `rule`, `bucket`, `prefix` and `suffix` (empty for "any"). Each key's beginnings, at the
    lengths that the rules' prefixes have, are looked up together with the bucket, so the work does not
    grow with the number of rules of a bucket; the suffix is compared last. Rules beyond the broadcast
    limit are joined salted.
    """
    allow_repeated_keys(messages.sparkSession)
    parsed = messages.select(*keys, F.try_parse_json(F.col(message)).alias("_message"))
    taken = parsed.select(*keys, _at(F.col("_message"), "$", _BUS_EVENT).alias("_bus"))
    bus = F.col("_bus")
    is_created = (bus["source"] == BUS_SOURCE) & (bus["detail-type"] == BUS_DETAIL_TYPE)
    bucket, key = bus["detail"]["bucket"]["name"], bus["detail"]["object"]["key"]
    place = F.struct(bucket.alias("bucket"), key.alias("object_key"))
    # An array of one or none instead of a filter: Spark would push the filter down and parse twice.
    created = taken.select(*keys, F.inline(F.when(is_created, F.array(place))))
    wanted = rules.select("rule", "bucket", "prefix", "suffix")
    small = limit.local_copy(wanted, wanted.columns)
    if small is None:
        created = stage(created, "created")
    # At most as many values as the longest prefix has characters.
    lengths = (small if small is not None else wanted).select(F.length("prefix").alias("n")).filter("n IS NOT NULL")
    lengths = sorted(row["n"] for row in lengths.distinct().collect())
    reached = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("object_key"))
    begun = created.select("*", F.explode(reached).alias("_length"))
    begun = begun.select("*", F.expr("substring(object_key, 1, _length)").alias("prefix")).drop("_length")
    if small is not None:
        joined = begun.join(F.broadcast(small), ["bucket", "prefix"])
    else:
        joined = salted_join(begun, wanted, ["bucket", "prefix"])
    fitting = joined.filter(F.expr("endswith(object_key, suffix)"))
    arguments = job_arguments(F.col("bucket"), F.col("object_key"), env, metrics=False)
    return fitting.select(*keys, "rule", "bucket", "object_key", arguments.alias("arguments"))


def job_arguments(bucket: Column, object_key: Column, env: str = DEFAULT_ENV, metrics: bool = True) -> Column:
    """Argument map of the job an event starts."""
    pairs = [F.lit("--bucket"), bucket, F.lit("--object_key"), object_key, F.lit("--env"), F.lit(env)]
    if metrics:
        pairs += [F.lit("--enable_metrics"), F.lit("true")]
    return F.create_map(*pairs)


def dispatch_plan(
    messages: DataFrame,
    routes: DataFrame | None = None,
    env: str = DEFAULT_ENV,
    message: str = "message",
    keys: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """What each message leads to: one row per event, or one row for a message without events.

    `status` is `matched` (with `job_name` and `arguments`), `skipped` or `error`. A message that is
    not JSON is an error of its own; so is one with an event that has no key.
    """
    read = read_messages(messages, message, keys)
    has_key = ~F.exists("events", lambda event: event["object_key"].isNull())
    sound = read.select(
        *keys, F.when(has_key, F.col("events")).alias("events"), (F.col("is_readable") & has_key).alias("is_sound")
    )
    rows = sound.select(*keys, "is_sound", F.posexplode_outer("events").alias("_position", "_event")).select(
        *keys, "is_sound", (F.col("_position") + 1).cast("int").alias("event_no"), "_event.*"
    )
    routed = route_jobs(rows, routes, env, **options)
    job, is_event = F.col("job_name"), F.col("event_no").isNotNull()
    return routed.select(
        *keys,
        "event_no",
        "bucket",
        "object_key",
        "event_name",
        "job_name",
        F.when(job.isNotNull(), job_arguments(F.col("bucket"), F.col("object_key"), env)).alias("arguments"),
        F.when(~F.col("is_sound"), F.lit("error"))
        .when(job.isNotNull(), F.lit("matched"))
        .otherwise(F.lit("skipped"))
        .alias("status"),
        F.when(~F.col("is_sound") | job.isNotNull(), F.lit(None).cast("string"))
        .when(is_event, F.lit(NO_JOB))
        .otherwise(F.lit(NO_EVENTS))
        .alias("reason"),
    )


def dispatch_envelopes(
    envelopes: DataFrame,
    routes: DataFrame | None = None,
    env: str = DEFAULT_ENV,
    envelope: str = "envelope",
    keys: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """The dispatch plan of every queue record in the envelopes, keyed by `(*keys, record_no)`."""
    messages = unwrap_envelopes(envelopes, envelope, keys)
    return dispatch_plan(messages, routes, env, keys=(*keys, "record_no"), **options)


def dispatch_summary(plan: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Per message: its status and how many jobs it starts. Rows of one message meet map-side first."""
    started = F.count_if(F.col("job_name").isNotNull())
    return plan.groupBy(*keys).agg(
        F.when(F.max(F.col("status") == "error"), F.lit("error"))
        .when(F.max(F.col("event_no")).isNull(), F.lit("skipped"))
        .otherwise(F.lit("success"))
        .alias("status"),
        started.alias("jobs_started"),
    )
