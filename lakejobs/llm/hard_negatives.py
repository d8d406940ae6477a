"""Hard negatives for anchors: rows of other labels that score nearly as high as a positive, by exact integer scores.

Scores are inner products of integer vectors. Matrices of the components' residues modulo several small primes are
multiplied in float32; each sum stays below 2**24, so each product is exact. A score is put together from its residues
by Chinese remaindering (balanced mixed radix digits, so signs come out right). The number of primes follows from the
largest vector.

The anchors, a stated share of all rows, are written in blocks to the shared folder, and workers map them. Every task
multiplies its rows, a bounded chunk at a time, with all blocks and hands back a few rows per anchor and chunk. Spark
windows over these choose: first the positives, then, in a second pass, what lies in each positive's range of scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakejobs.llm.files import sections, write_arrays
from lakejobs.llm.shared import keep
from lakejobs.session import scratch, stage, staging_path

# Dimensions multiplied at once: with residues up to 511 on either side of 0, 64 products stay below 2**24.
_DIMENSIONS = 64
# Primes below 1024, largest first; fixed values. Seven of them tell all scores up to 2**60 apart.
_PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
# Vectors whose squares sum up to this or more could have scores, or five times them, that leave 64 bits.
_LARGEST = 1 << 59
_NONE = np.iinfo(np.int64).min


@dataclass(frozen=True)
class MiningParams:
    """Components are floor(`scale` * x). `positives` rows of its label per anchor, `negatives` of others for each.

    A negative's score is between `low` and `high` percent of the positive's. Anchors are in blocks of `block`;
    a task looks at `chunk` rows at a time, and multiplies `tile` of them at once.
    """

    scale: int = 256
    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    block: int = 512
    chunk: int = 65_536
    tile: int = 4096


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as tell apart all whole numbers from -bound to bound, two at least."""
    product, count = 1, 0
    while count < 2 or product <= 2 * bound:
        product, count = product * _PRIMES[count], count + 1
    return _PRIMES[:count]


def residues(vectors: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """Float32 matrices of the components modulo each prime, from -(p - 1) / 2 to (p - 1) / 2."""
    out = []
    for p in primes:
        half = (p - 1) // 2
        out.append((np.mod(vectors + half, p) - half).astype(np.float32))
    return out


def exact_scores(left: list[np.ndarray], right: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """All inner products of two sets of vectors, given by their residues; a row for each vector of `left`."""
    shape = (len(left[0]), len(right[0]))
    value, weight = np.zeros(shape, np.int64), 1
    for i, p in enumerate(primes):
        total = np.zeros(shape, np.int64)
        for low in range(0, left[i].shape[1], _DIMENSIONS):
            part = slice(low, low + _DIMENSIONS)
            total += (left[i][:, part] @ right[i][:, part].T).astype(np.int64)
        # The digit of weight p0 * p1 * ..., balanced: what is known so far is taken off, the weight divided out.
        half = (p - 1) // 2
        digit = np.mod((total - value) % p * pow(weight, -1, p) + half, p) - half
        value += digit * weight
        weight *= p
    return value


def first_places(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The places and values of each row's `count` highest scores, earlier places first on ties; _NONE is none."""
    rows = np.arange(len(scores))
    places, values = [], []
    scores = scores.copy()
    for _ in range(min(count, scores.shape[1])):
        best = scores.argmax(axis=1)
        places.append(best)
        values.append(scores[rows, best])
        scores[rows, best] = _NONE
    if not places:
        return np.zeros((len(scores), 0), np.int64), np.zeros((len(scores), 0), np.int64)
    return np.stack(places, axis=1), np.stack(values, axis=1)


def _prepared(rows: DataFrame, label: Column, anchor: Column, params: MiningParams) -> DataFrame:
    """(row, vec_id, label, anchor, size, squares, vector): the rows that take part; vectors as 32-bit integers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, squares, bodies = [], [], [], []
            for i, value in enumerate(batch.column("embedding")):
                if not value.is_valid or value.values.null_count:
                    continue
                x = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(params.scale * x)
                    square = float(x @ x)
                if not square < _LARGEST:
                    continue
                kept.append(i)
                sizes.append(len(x))
                squares.append(int(square * (1 + 1e-9)) + 1)
                bodies.append(x.astype("<i4").tobytes())
            some = batch.select(["row", "vec_id", "label", "anchor"]).take(pa.array(kept, pa.int64()))
            columns = [pa.array(sizes, pa.int32()), pa.array(squares, pa.int64()), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays([*some.columns, *columns], [*some.schema.names, "size", "squares", "vector"])

    plain = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        "embedding",
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL")
    schema = "row long, vec_id long, label long, anchor boolean, size int, squares long, vector binary"
    return plain.mapInArrow(cut, schema)


def _matrix(vectors: pa.ChunkedArray, size: int) -> np.ndarray:
    body = b"".join(x.as_buffer().to_pybytes() for x in vectors)
    return np.frombuffer(body, "<i4").astype(np.int64).reshape(len(vectors), size)


def _written_blocks(anchors: DataFrame, folder: str, with_positives: bool) -> list[dict]:
    """Write each block of anchors to a file; (size, path, n) of all, one row per `block` anchors."""

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        size = table.column("size")[0].as_py()
        arrays = [table.column(x).to_numpy() for x in ("row", "vec_id", "label")]
        if with_positives:
            lists = table.column("bounds").to_pylist()
            most = max(len(x) for x in lists)
            bounds = np.full((len(lists), most), _NONE, np.int64)
            for i, x in enumerate(lists):
                bounds[i, : len(x)] = sorted(x, reverse=True)
            arrays.append(bounds)
        else:
            most = 0
        path = write_arrays(folder, "anchors", [*arrays, _matrix(table.column("vector"), size)])
        out = {"size": [size], "path": [path], "n": [table.num_rows], "most": [most]}
        return pa.table(out, pa.schema([("size", pa.int32()), ("path", pa.string()), ("n", pa.int64()), ("most", pa.int32())]))

    written = stage(anchors.groupBy("size", "block").applyInArrow(write, "size int, path string, n long, most int"), "mining-blocks")
    return [row.asDict() for row in written.toLocalIterator()]


def _read_block(block: dict) -> list[np.ndarray]:
    n, most = block["n"], block["most"]
    row, vec_id, label, bounds, vectors = sections(
        block["path"], (np.int64, n), (np.int64, n), (np.int64, n), (np.int64, n * most), (np.int64, n * block["size"])
    )
    return [np.array(x) for x in (row, vec_id, label)] + [np.array(bounds).reshape(n, most), np.array(vectors).reshape(n, block["size"])]


def _scan(rows: DataFrame, blocks: list[dict], primes: tuple[int, ...], params: MiningParams) -> DataFrame:
    """(anchor_row, anchor_id, bound, score, vec_id, row): for each chunk of rows, its best for each anchor.

    Without bounds in the blocks: the best of the anchor's label. With them: for each bound, the best of other
    labels whose scores lie in its range.
    """
    names = ["anchor_row", "anchor_id", "bound", "score", "vec_id", "row"]

    def of_block(block: dict, found: dict[str, np.ndarray], vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        own_row, own_id, own_label, bounds, own_vectors = _read_block(block)
        left = residues(own_vectors, primes)
        count = params.negatives if block["most"] else params.positives
        # One set of best rows for each bound; rows come in the order of (vec_id, row), so earlier ones win ties.
        ranges = [bounds[:, [j]] for j in range(block["most"])] or [None]
        best = [(np.full((len(own_row), 0), 0, np.int64), np.full((len(own_row), 0), _NONE, np.int64)) for _ in ranges]
        for low in range(0, len(vectors), params.tile):
            part = slice(low, low + params.tile)
            scores = exact_scores(left, residues(vectors[part], primes), primes)
            same = own_label[:, None] == found["label"][None, part]
            for j, bound in enumerate(ranges):
                if bound is None:
                    good = same & (own_row[:, None] != found["row"][None, part])
                else:
                    good = ~same & (bound != _NONE) & _in_range(scores, bound, params)
                    if not good.any():
                        continue
                places, values = first_places(np.where(good, scores, _NONE), count)
                places, values = (np.concatenate(x, axis=1) for x in ((best[j][0], places + low), (best[j][1], values)))
                at, values = first_places(values, count)
                best[j] = np.take_along_axis(places, at, axis=1), values
        for (places, values), bound in zip(best, ranges, strict=True):
            i, k = np.nonzero(values != _NONE)
            at = places[i, k]
            none = pa.nulls(len(i), pa.int64())
            columns = [own_row[i], own_id[i], none if bound is None else bound[i, 0], values[i, k], found["vec_id"][at], found["row"][at]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)

    def of_chunk(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        chunk = chunk.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        sizes = chunk.column("size").to_numpy()
        for size in np.unique(sizes).tolist():
            part = chunk.take(np.flatnonzero(sizes == size))
            found = {x: part.column(x).to_numpy() for x in ("row", "vec_id", "label")}
            vectors = _matrix(part.column("vector"), size)
            for block in blocks:
                if block["size"] == size:
                    yield from of_block(block, found, vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= params.chunk:
                yield from of_chunk(pa.Table.from_batches(held))
                held = []
        if sum(x.num_rows for x in held):
            yield from of_chunk(pa.Table.from_batches(held))

    return rows.select("row", "vec_id", "label", "size", "vector").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _in_range(scores: np.ndarray, bound: np.ndarray, params: MiningParams) -> np.ndarray:
    """low * bound <= 100 * score <= high * bound, in bounds of whole numbers found for each bound once."""
    floor, ceiling = np.full(bound.shape, 1, np.int64), np.full(bound.shape, 0, np.int64)
    for i, x in enumerate(bound[:, 0].tolist()):
        if x != _NONE:
            floor[i, 0], ceiling[i, 0] = -(-params.low * x // 100), params.high * x // 100
    return (scores >= floor) & (scores <= ceiling)


def mine_hard_negatives(rows: DataFrame, anchor: Column, label: Column | None = None, params: MiningParams | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hard negatives of each positive.

    `rows` needs `vec_id`, `embedding` and what the columns `anchor` (which rows are anchors) and `label` (the column
    `label` by default) use; other columns are ignored. A score is the inner product of floor(scale * component).
    Higher scores come first, ties by smaller vec_id. An anchor's positives are its first `positives` other rows of its
    label; a positive's negatives the first `negatives` rows of other labels in its range of scores, ranked from 1.

    Rows with a null vec_id, label, vector or component, or a component that is not finite, take no part, nor do
    vectors whose integers' squares sum up to 2**59 or more, as scores could leave 64 bits. Rows of vectors of different
    sizes do not meet. Rows that repeat a vec_id count each: other rows are all but the anchor's own row, and equal
    ids go by their place. Anchors without positives, and positives without negatives, have no rows; so has an empty table.
    """
    params = params or MiningParams()
    label = F.col("label") if label is None else label
    spark = rows.sparkSession
    with scratch(spark):
        folder = staging_path(spark, "mining-anchors")
        usable = stage(_prepared(rows, label, anchor, params), "mining-rows")
        # No inner product is larger than the largest vector's with itself.
        largest = usable.agg(F.max("squares")).first()[0]
        anchors = usable.filter("anchor")
        n_blocks = F.ceil(F.count(F.lit(1)) / params.block)
        sizes = anchors.groupBy("size").agg(n_blocks.alias("blocks"))
        # One row per size of vectors there is.
        dealt = anchors.join(F.broadcast(sizes), "size").withColumn("block", F.pmod(F.xxhash64("row"), "blocks"))
        dealt = stage(dealt.select("size", "block", "row", "vec_id", "label", "vector"), "mining-dealt")
        primes = primes_for(int(largest or 1))

        blocks = _written_blocks(dealt, folder, False)
        order = [F.desc("score"), "vec_id", "row"]
        nearest = Window.partitionBy("anchor_row").orderBy(*order)
        positives = _scan(usable, blocks, primes, params).withColumn("at", F.row_number().over(nearest))
        positives = stage(positives.filter(F.col("at") <= params.positives).drop("bound"), "mining-positives")

        bounds = positives.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_set("score").alias("bounds"))
        blocks = _written_blocks(dealt.join(bounds, "row"), folder, True)
        in_range = Window.partitionBy("anchor_row", "bound").orderBy(*order)
        negatives = _scan(usable, blocks, primes, params).withColumn("rank", F.row_number().over(in_range))
        negatives = negatives.filter(F.col("rank") <= params.negatives)
        negatives = negatives.select("anchor_row", "bound", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        named = positives.select("anchor_row", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        pairs = named.join(negatives, (named.anchor_row == negatives.anchor_row) & (named.positive_score == negatives.bound))
        columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        return keep(pairs.select(columns), "hard-negatives")
