"""Near-duplicate documents by min-max hashing of word shingles, confirmed on the full sets.

1. Each document's shingles are hashed in its own task; of every permutation both the smallest and the
   largest value are kept, so that half the permutations fill a signature. Bands of it become bucket keys.
2. Documents with equal sets become one node. Buckets with one node are dropped.
3. In each bucket, nodes are paired with two leaders (the smallest node, and one drawn per bucket), so
   pairs grow with the bucket and not with its square. Sets of paired nodes only are made again from
   the texts, and pairs are confirmed on them. Links are joined to components.
4. Of buckets that still hold several components, the nodes' shingles are put in order of how few of these nodes have
   them. Alike sets have a common one among the first ones of both, so nodes of different components meet there, unless
   its places, or the sets' parities, leave too few common ones: exact filters, whose pairs are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakejobs.llm.components import connected_components
from lakejobs.llm.shared import chunks, keep, text_bytes
from lakejobs.llm.words import SPACED, hashes, mix, spans, windows
from lakejobs.session import scratch, stage

# Bytes of text looked at together; arrays over their bytes and words take many times that.
_CHUNK = 1 << 20


@dataclass(frozen=True)
class MinMaxParams:
    """Shingle width, the least similarity in percent, and the signature's shape.

    With 25 bands of 5 values, a pair at 80 % shares a bucket with probability 0.99995, one at 90 % with
    more than 1 - 1e-9. Ids of documents whose sets are needed are broadcast up to `broadcast_ids`, counted
    first; beyond, texts are shuffled to meet them.
    """

    width: int = 5
    percent: int = 80
    bands: int = 25
    rows: int = 5
    broadcast_ids: int = 1_000_000
    seed: int = 7


def document_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's start."""
    data, offsets = text_bytes(texts)
    starts, ends, first = spans(data, offsets, SPACED)
    shingles, bounds = windows(hashes(data, starts, ends), first, width)
    sets = [np.unique(shingles[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    sizes = [len(x) for x in sets]
    return (np.concatenate(sets) if sets else shingles), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def signatures(values: np.ndarray, bounds: np.ndarray, params: MinMaxParams) -> np.ndarray:
    """Bucket keys of each non-empty set, `bands` of them, from the minima and maxima of all permutations."""
    count = -(-params.bands * params.rows // 2)
    draw = np.random.Generator(np.random.PCG64(params.seed))
    factors = draw.integers(1, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = draw.integers(0, 1 << 63, count, np.uint64)
    first = bounds[:-1][np.diff(bounds) > 0]
    kept = np.empty((2 * count, len(first)), np.uint64)
    for i in range(count if len(first) else 0):
        permuted = values * factors[i] + shifts[i]
        kept[2 * i] = np.minimum.reduceat(permuted, first)
        kept[2 * i + 1] = np.maximum.reduceat(permuted, first)
    keys = np.empty((params.bands, len(first)), np.uint64)
    for band in range(params.bands):
        key = np.full(len(first), band + 1, np.uint64)
        for row in kept[band * params.rows : (band + 1) * params.rows]:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + row)
        keys[band] = key
    return keys.T


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    place = np.searchsorted(large, small)
    place[place == len(large)] = 0
    both = int((large[place] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sketch(docs: DataFrame, params: MinMaxParams) -> DataFrame:
    """(doc_id, n_shingles, digest, keys): digest is null and keys are empty where the set is empty."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", _CHUNK):
                values, bounds = document_sets(part.column("text"), params.width)
                sizes = np.diff(bounds)
                filled = sizes > 0
                keys = np.zeros((len(sizes), params.bands), np.uint64)
                keys[filled] = signatures(values, bounds, params)
                ends = np.concatenate([[0], np.cumsum(np.where(filled, params.bands, 0))])
                # Sums of two mixed forms name a set but for chance of about 2**-120.
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (values, mix(values))]
                digest = [f"{int(a):016x}{int(b):016x}" for a, b in zip(*((s[bounds[1:]] - s[bounds[:-1]]) for s in sums), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(digest, pa.string(), mask=~filled),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[filled].ravel().view(np.int64))),
                    ],
                    ["doc_id", "n_shingles", "digest", "keys"],
                )

    schema = "doc_id long, n_shingles long, digest string, keys array<long>"
    return docs.select("doc_id", "text").mapInArrow(sketch, schema)


def _sets(docs: DataFrame, params: MinMaxParams) -> DataFrame:
    """(node, shingles): the sorted set as bytes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", _CHUNK):
                values, bounds = document_sets(part.column("text"), params.width)
                body = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(body, pa.binary())], ["node", "shingles"]
                )

    return docs.select("doc_id", "text").mapInArrow(make, "node long, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked. A leader's set meets all its partners in joins that can be split."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(name) for name in ("x", "y"))
            good = [
                linked(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent)
                for a, b in zip(x, y, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    with_b = with_a.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return with_b.select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long")


def _tokens(open_nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, component, n, token): a row for each shingle of the nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column("shingles")[i].as_buffer(), np.int64)
                rows = pa.array(np.full(len(own), i))
                columns = [batch.column(x).take(rows) for x in ("node", "component")]
                columns += [pa.array(np.full(len(own), len(own))), pa.array(own)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "component", "n", "token"])

    filled = open_nodes.join(sets, "node").select("node", "component", "shingles")
    return filled.mapInArrow(run, "node long, component long, n long, token long")


def parities(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each set, for each of 256 classes of shingles, whether it holds an odd number of them; as four numbers.

    A shingle that only one of two sets holds changes one bit, so the sets differ in as many shingles as bits, or in more.
    """
    sets = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places = sets * 256 + (mix(values) >> np.uint64(56)).astype(np.int64)
    odd = (np.bincount(places, minlength=256 * (len(bounds) - 1)) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, 256), axis=1).view(np.int64)


def _parities(sets: DataFrame) -> DataFrame:
    """(node, p0 to p3): the parities of the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]
            found = [parities(x, np.array([0, len(x)])) for x in own]
            columns = np.concatenate(found).T if found else np.empty((4, 0), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("node"), *map(pa.array, columns)], ["node", "p0", "p1", "p2", "p3"])

    return sets.select("node", "shingles").mapInArrow(run, "node long, p0 long, p1 long, p2 long, p3 long")


def _rest(members: DataFrame, links: DataFrame, pairs: DataFrame, sets: DataFrame, params: MinMaxParams) -> DataFrame | None:
    """Further links, of nodes in buckets that two leaders did not settle; None if there is no such bucket.

    Of two sets that are alike enough, the shingles that are rarest among these nodes' hold a common one: of n, the first
    n - ceil(n * percent / 100) + 1. Nodes with a common one there, and of different components, are pairs to confirm.
    The first common one has nothing common before it, so its places bound the number of common shingles, and so do the
    sets' parities; a pair is made only if both bounds leave enough for a link.
    """
    found = connected_components(links)
    placed = members.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    held = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_keys = held.filter("low <> high").select("key")
    open_nodes = stage(placed.join(open_keys, "key", "left_semi").select("node", "component").distinct(), "minhash-open")
    if open_nodes.isEmpty():
        return None
    tokens = stage(_tokens(open_nodes, sets), "minhash-tokens")
    # A shingle that one node has alone comes first and meets nothing.
    shared = tokens.groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1")
    known = tokens.join(shared, "token")
    rarest = Window.partitionBy("node").orderBy("holders", "token")
    alone = F.col("n") - F.count("*").over(Window.partitionBy("node"))
    ranked = known.withColumns({"at": F.row_number().over(rarest) + alone, "least": F.ceil(F.col("n") * params.percent / 100)})
    first = ranked.filter("at <= n - least + 1").select("token", "node", "component", "n", "at")
    prefixes = stage(first.join(_parities(sets), "node"), "minhash-prefixes")
    # Of a shingle's holders, those of the component that most of them are in meet only the others.
    per = prefixes.groupBy("token", "component").agg(F.count("*").alias("held"))
    main = per.groupBy("token").agg(F.max_by("component", F.struct("held", "component")).alias("main"), F.count("*").alias("parts"))
    waiting = prefixes.join(main.filter("parts > 1").select("token", "main"), "token")
    own = [x for x in waiting.columns if x not in ("token", "main")]
    outside = waiting.filter("component <> main").select("token", *own)
    whole = waiting.select("token", *(F.col(x).alias(f"{x}2") for x in own))
    # A link needs (100 + percent) * common >= percent * both.
    both = F.col("n") + F.col("n2")
    unlike = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"p{i}2"))) for i in range(4)), F.lit(0))
    left = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2")) + 1
    fits = ((100 + params.percent) * left >= params.percent * both) & (
        (100 + params.percent) * (both - unlike) >= 2 * params.percent * both
    )
    met = outside.join(whole, "token").filter((F.col("component") != F.col("component2")) & fits)
    met = met.select(F.greatest("node", "node2").alias("a"), F.least("node", "node2").alias("b")).distinct()
    # What the leaders' pairs have shown already is not asked again.
    return _confirmed(met.join(pairs, ["a", "b"], "left_anti"), sets, params.percent)


def near_duplicates(docs: DataFrame, params: MinMaxParams | None = None) -> DataFrame:
    """One row per document: n_shingles, component_id (smallest doc_id it is linked with), kept.

    `docs` needs an integer `doc_id` and `text`; other columns are ignored. Words are runs of anything
    but ASCII white space, A-Z counting as a-z. A text of fewer words than a shingle has one shingle of
    all of them. A null or wordless text has an empty set, is linked with nothing and kept. Rows that
    repeat a `doc_id` are each returned, all with the component of their own text; a null `doc_id` is
    linked with nothing, gets a null component and is kept. An empty table gives no rows.
    """
    params = params or MinMaxParams()
    with scratch(docs.sparkSession):
        sketch = stage(_sketch(docs, params), "minhash-sketch")
        usable = sketch.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
        nodes = stage(
            usable.groupBy("digest").agg(
                F.min("doc_id").alias("node"), F.any_value("keys").alias("keys"), F.any_value("n_shingles").alias("n")
            ),
            "minhash-nodes",
        )
        entries = nodes.select("node", "n", F.explode("keys").alias("key"))
        drawn = F.struct(F.xxhash64("node", "key").alias("draw"), "node", "n")
        leaders = (
            entries.groupBy("key")
            .agg(F.count("*").alias("rows"), F.min(F.struct("node", "n")).alias("one"), F.min(drawn).alias("two"))
            .filter("rows > 1")
            .select("key", F.array("one", F.col("two").dropFields("draw")).alias("leaders"))
        )
        members = stage(entries.join(leaders, "key"), "minhash-members")
        led = members.select("node", "n", F.explode("leaders").alias("leader")).select("node", "n", "leader.*")
        led = led.toDF("node", "n", "leader", "m").filter("node <> leader")
        fits = 100 * F.least("n", "m") >= params.percent * F.greatest("n", "m")
        pairs = led.filter(fits).select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b"))
        pairs = stage(pairs.distinct(), "minhash-pairs")

        # Texts are read into sets again for documents that share a bucket, once for all that follows.
        named = stage(members.select(F.col("node").alias("doc_id")).distinct(), "minhash-named")
        few = named.limit(params.broadcast_ids + 1).count() <= params.broadcast_ids
        named = F.broadcast(named) if few else named
        sets = stage(_sets(docs.join(named, "doc_id", "left_semi"), params), "minhash-sets")
        links = stage(_confirmed(pairs, sets, params.percent), "minhash-links")
        more = _rest(members.select("key", "node"), links, pairs, sets, params)
        components = connected_components(links if more is None else stage(links.union(more), "minhash-links"))
        classes = nodes.select("digest", "node").join(components, "node", "left")
        classes = classes.select("digest", F.coalesce("component", "node").alias("component_id"))
        result = sketch.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        return keep(
            result.select(
                "doc_id",
                "n_shingles",
                component.alias("component_id"),
                F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
            ),
            "minhash",
        )
