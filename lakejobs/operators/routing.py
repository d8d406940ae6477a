"""Send object keys to jobs by the longest matching prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.bounded import BroadcastLimit, salted_join
from lakejobs.session import stage

# The jobs that take keys no custom route claims, by prefix, without the environment.
DEFAULT_ROUTES = {
    "sales/": "sales_etl",
    "customers/": "customer_import",
    "inventory/": "inventory_sync",
    "products/": "product_catalog",
}
DEFAULT_ENV = "dev"

# Up to so many routes, looking through one group costs less than further hash probes.
ONE_TIER_ROUTES = 64
MAX_TIERS = 8


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def parse_route_specs(specs: DataFrame, spec: str = "spec", keys: tuple[str, ...] = ()) -> DataFrame:
    """Routes `(*keys, prefix, job)` from texts like `sales/:job1,data/:job2`.

    An entry without a colon is skipped, the first colon divides, and the last of entries with the
    same prefix counts.
    """
    entry = F.col("_entry")
    entries = specs.select(*keys, F.posexplode(F.split(F.col(spec), ",")).alias("_position", "_entry"))
    parts = entries.filter(F.contains(entry, F.lit(":"))).select(
        *keys,
        "_position",
        _strip(F.substring_index(entry, ":", 1)).alias("prefix"),
        _strip(F.regexp_replace(entry, r"(?s)^[^:]*:", "")).alias("job"),
    )
    return parts.groupBy(*keys, "prefix").agg(F.max_by("job", "_position").alias("job"))


def default_route(object_key: Column, env: str = DEFAULT_ENV) -> Column:
    """Job of the default routes, NULL when none matches."""
    matches = [
        F.when(F.startswith(object_key, F.lit(prefix)), F.lit(f"{env}-{job}")) for prefix, job in DEFAULT_ROUTES.items()
    ]
    return F.coalesce(*matches)


def route_longest_prefix(
    df: DataFrame,
    routes: DataFrame,
    key: str = "object_key",
    job: str = "job_name",
    limit: BroadcastLimit = BroadcastLimit(),
) -> DataFrame:
    """Add `job`: that of the longest route prefix the key starts with, or NULL.

    `routes` has `prefix` and `job`. Of several jobs of one prefix the first by text counts; the empty
    prefix never matches, and a route to an empty job claims the key without giving it a job. A route
    table within `limit` is broadcast and `df` is not shuffled. A larger one is joined on the keys' own
    prefixes, and `df` is written to the shared folder before, so that its plan runs once.
    """
    named = routes.filter(F.col("prefix") != "").select("prefix", F.coalesce("job", F.lit("")).alias("_job"))
    usable = named.groupBy("prefix").agg(F.min("_job").alias("_job"))
    small = limit.local_copy(usable, ["prefix", "_job"])
    if small is None:
        routed = _route_shuffled(stage(df, "routed"), stage(usable, "routes"), key)
    else:
        routed = _route_broadcast(df, small, key)
    return routed.withColumn(job, F.nullif(F.col("_job"), F.lit(""))).drop("_job")


def _route_broadcast(df: DataFrame, routes: DataFrame, key: str) -> DataFrame:
    """Hash probes without a shuffle, one per tier of prefix lengths.

    The routes of a tier lie grouped under as many first characters as its shortest prefix has. A
    key finds its group by one probe and looks for the longest prefix there.
    """
    prefixes = [row["prefix"] for row in routes.collect()]
    lengths = sorted({len(prefix) for prefix in prefixes})
    tiers = 1 if len(prefixes) <= ONE_TIER_ROUTES else MAX_TIERS
    floors = lengths[:: max(1, -(-len(lengths) // tiers))]
    matches = []
    for tier, (low, high) in enumerate(zip(floors, [*floors[1:], None])):
        length = F.length("prefix")
        within = routes.filter((length >= low) & (length < high) if high else length >= low)
        candidate = F.struct((-length).alias("rank"), "prefix", "_job")
        heads = within.groupBy(F.substring("prefix", 1, low).alias("_head")).agg(
            F.sort_array(F.collect_list(candidate)).alias(f"_tier{tier}")
        )
        df = df.withColumn("_head", F.substring(F.col(key), 1, low))
        df = df.join(F.broadcast(heads), "_head", "left").drop("_head")
        matching = F.filter(f"_tier{tier}", lambda route: F.startswith(F.col(key), route["prefix"]))
        matches.insert(0, F.get(matching, F.lit(0))["_job"])
    found = F.coalesce(*matches) if matches else F.lit(None).cast("string")
    return df.withColumn("_job", found).drop(*[f"_tier{tier}" for tier in range(len(floors))])


def _route_shuffled(df: DataFrame, routes: DataFrame, key: str) -> DataFrame:
    """Equi-join of each distinct key's prefixes with the routes; both joins are salted against hot values."""
    # At most as many values as the longest prefix has characters.
    lengths = sorted(row[0] for row in routes.select(F.length("prefix")).distinct().collect())
    keys = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("_key"))
    candidates = keys.select("_key", F.explode(fitting).alias("_length")).select(
        "_key", "_length", F.expr("substring(_key, 1, _length)").alias("prefix")
    )
    matched = salted_join(candidates, routes, ["prefix"])
    best = matched.groupBy("_key").agg(F.max_by("_job", "_length").alias("_job"))
    return salted_join(df.withColumn("_key", F.col(key)), best, ["_key"], how="left", staged=True).drop("_key")


def route_jobs(
    df: DataFrame,
    routes: DataFrame | None = None,
    env: str = DEFAULT_ENV,
    key: str = "object_key",
    job: str = "job_name",
    **options,
) -> DataFrame:
    """Custom routes first, then the default ones."""
    default = default_route(F.col(key), env)
    if routes is None:
        return df.withColumn(job, default)
    routed = route_longest_prefix(df, routes, key, job, **options)
    return routed.withColumn(job, F.coalesce(F.col(job), default))
