"""Find passages of a benchmark in documents, by window hashes, with built-in functions alone.

A document's words are cut once. Each place in it is hashed with the words behind it, and the hash
probes the windows of all items. A hit is confirmed by the words themselves, so a hash that happens to
be equal does no harm. Only hits and one row per document leave the task that read the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
# Windows of the items up to so many rows are sent to every executor; above, both sides are shuffled.
BROADCAST_WINDOWS = 200_000

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of text whose A-Z are lower-cased
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """The text's words; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN_WORDS), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, size, gram): each item's windows of `window` words, or all its words where it has fewer.

    Equal windows of one item count once. Items without words, or with a null `item_id`, have none.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
    sized = items.filter("item IS NOT NULL AND size(w) > 0").withColumn("size", F.least(F.size("w"), F.lit(window)))
    start = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1))
    grams = sized.select("item", "size", "w", start.alias("at"))
    return grams.select("item", "size", F.slice("w", F.col("at"), F.col("size")).alias("gram")).distinct()


def _key(words: Column, at: Column, size: Column) -> Column:
    """Hash of a window's first and last word and two between, spread evenly; the others are compared on a hit."""
    picked = [F.get(words, at - 1 + F.floor((size - 1) * i / 3).cast("int")) for i in range(4)]
    return F.xxhash64(*picked)


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated, hits, items.

    `docs` needs `doc_id` and `text`, `benchmark` needs `item_id` and `text`; other columns are ignored.
    `hits` lists the passages as (start, end) in words, joined where they overlap. Null and wordless
    texts have no words and are clean. A null `doc_id` stays null. Rows of one `doc_id` and text each come
    out. An item id stands for all rows that carry it. An empty benchmark leaves all documents clean.
    The windows are broadcast when their number, counted first, allows; the result is the same if not.
    """
    grams = item_windows(benchmark, window).groupBy("size", "gram").agg(F.collect_set("item").alias("items"))
    grams = grams.withColumn("hash", _key(F.col("gram"), F.lit(1), F.col("size")))
    sizes = sorted(row["size"] for row in grams.select("size").distinct().limit(window).toLocalIterator())
    small = grams.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    texts = docs.select("doc_id", F.xxhash64("text").alias("t1"), F.hash("text").alias("t2"), words_of(F.col("text")).alias("w"))

    # Place 0 stands for the document itself, so that its row is there without a hit; behind it come the
    # starts of windows, size by size.
    left = F.col("place")
    at, size_of = F.when(left == 0, 0), F.when(left == 0, 0)
    for size in sizes:
        starts = F.greatest(F.size("w") - F.lit(size - 1), F.lit(0))
        at, size_of = at.when((left > 0) & (left <= starts), left), size_of.when((left > 0) & (left <= starts), size)
        left = left - starts
    places = sum((F.greatest(F.size("w") - F.lit(size - 1), F.lit(0)) for size in sizes), F.lit(0))
    placed = texts.select("*", F.explode(F.sequence(F.lit(0), places)).alias("place"))
    placed = placed.select("doc_id", "t1", "t2", "w", at.alias("at"), size_of.alias("size"))
    gram = F.slice("w", F.greatest("at", F.lit(1)), F.col("size"))
    n_words = F.when(F.col("at") == 0, F.size("w").cast("long")).alias("n_words")
    right = grams.select("hash", F.col("gram").alias("g"), "items")
    # Hashes alone are joined on, as one number makes the quickest key; the words decide right behind.
    if small:
        probe = placed.withColumn("hash", F.when(F.col("at") > 0, _key(F.col("w"), F.col("at"), F.col("size"))))
        found = probe.join(F.broadcast(right), "hash", "left").filter((F.col("at") == 0) | (gram == F.col("g")))
        found = found.select("doc_id", "t1", "t2", n_words, "at", "size", "items")
    else:
        probe = placed.filter("at > 0").select("doc_id", "t1", "t2", "at", "size", gram.alias("w"))
        probe = probe.withColumn("hash", _key(F.col("w"), F.lit(1), F.col("size")))
        hits = probe.join(right, "hash").filter("w = g").withColumn("n_words", F.lit(None).cast("long"))
        own = placed.filter("at = 0").withColumn("items", F.lit(None).cast("array<string>"))
        columns = ["doc_id", "t1", "t2", "n_words", "at", "size", "items"]
        found = own.withColumn("n_words", n_words).select(columns).union(hits.select(columns))

    hit = F.when(F.col("at") > 0, F.struct(F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end")))
    narrow = found.select("doc_id", "t1", "t2", "n_words", hit.alias("hit"), "items")
    # A document's hits are as many as its places at most, so they may stand in one row.
    grouped = narrow.groupBy("doc_id", "t1", "t2").agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("copies"),
        F.sort_array(F.collect_set("hit")).alias("hit"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )

    def add(spans: Column, x: Column) -> Column:
        last = F.element_at(spans, -1)
        apart = (F.size(spans) == 0) | (last["end"] < x["start"])
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(apart, F.concat(spans, F.array(x))).otherwise(
            F.concat(F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))), F.array(longer))
        )

    none = F.array().cast("array<struct<start:int,end:int>>")
    joined = grouped.withColumn("hits", F.aggregate("hit", none, add))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "hits",
        "items",
    )
