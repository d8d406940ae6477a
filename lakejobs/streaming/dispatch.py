"""Plan jobs for a stream of notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.bounded import BroadcastLimit
from lakejobs.operators.notifications import dispatch_plan
from lakejobs.operators.routing import DEFAULT_ENV
from lakejobs.session import scratch, stage
from lakejobs.streaming.ingest import finish


# Where notifications name an object and the sequence number of what happened to it.
_OBJECT = "struct<bucket: struct<name: string>, object: struct<key: string, sequencer: string>>"
_NOTED = f"Records array<struct<s3: {_OBJECT}>>, detail {_OBJECT}"


def message_identity(message: str = "message", keys: tuple[str, ...] = ()) -> Column:
    """What two messages of the same happenings share: a hash of 32 bytes, so that the state holds no texts.

    If every object in the message comes with a sequence number, it is their buckets, keys and numbers, in whatever
    message and shape they come; else the message's own `keys` and text.
    """
    noted = F.from_json(message, _NOTED)
    objects = F.coalesce(F.transform(noted["Records"], lambda record: record["s3"]), F.array(noted["detail"]))
    numbered = (F.size(objects) > 0) & F.forall(
        objects,
        lambda x: x["bucket"]["name"].isNotNull() & x["object"]["key"].isNotNull() & x["object"]["sequencer"].isNotNull(),
    )
    own = F.to_json(F.struct(*keys, F.col(message).alias("_text")), {"ignoreNullFields": "false"})
    return F.unhex(F.sha2(F.when(F.coalesce(numbered, F.lit(False)), F.to_json(objects)).otherwise(own), 256))


def once(messages: DataFrame, within: str, arrived: str, message: str = "message", keys: tuple[str, ...] = ()) -> DataFrame:
    """The stream without messages that repeat another one's happenings `within` some time of its arrival.

    `arrived` should be when a message came in, not when it was made: rows more than `within` older than the newest
    one seen are late and are left out. The state holds a hash per message of that time.
    """
    known = messages.withColumn("_identity", message_identity(message, keys)).withWatermark(arrived, within)
    return known.dropDuplicatesWithinWatermark(["_identity"]).drop("_identity")


def dispatch_stream(
    messages: DataFrame,
    sink: str,
    checkpoint: str,
    routes: DataFrame | None = None,
    env: str = DEFAULT_ENV,
    message: str = "message",
    keys: tuple[str, ...] = (),
    timeout: int = 3600,
    once_within: str | None = None,
    arrived: str = "arrived",
    **options,
) -> None:
    """Write the dispatch plan of all new messages to parquet below `sink`, then end.

    Each micro-batch overwrites its own folder `batch_id=<n>`, so one that is repeated after a
    failure leaves no second copy. Read the result with `spark.read.parquet(sink)`. With `once_within`
    (such as `7 days`) a notification that is sent again starts nothing, also in a later run; see `once`.
    """

    if routes is not None:
        limit = options.get("limit", BroadcastLimit())
        routes = limit.local_copy(routes, ["prefix", "job"]) or routes

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Copies that the plan makes of the micro-batch go when its rows are written.
        with scratch(batch.sparkSession):
            if once_within is not None:
                # Each look at the micro-batch would go through the state again.
                batch = stage(batch, "messages")
            plan = dispatch_plan(batch, routes, env, message, keys, **options)
            plan.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    if once_within is not None:
        messages = once(messages, once_within, arrived, message, keys)
    query = (
        messages.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout)
