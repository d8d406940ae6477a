"""Near-duplicate embeddings by navigable small-world graphs, one per shard.

Vectors of one label (and size) are dealt to shards of bounded size. Each shard becomes a hierarchical
graph, built in one task and written to the shared folder. Every pair of a label's shards is then one
small piece of work: the vectors of the one are searched for in the graph of the other. Beams are widened
where they hold links only, and as long as an audit against all vectors of the shard misses nearest ones. Links
are confirmed by cosine in double precision. A task hands back counts, and for each vector one edge to its
component within the piece, never pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.components import connected_components
from lakejobs.llm.files import sections, write_arrays
from lakejobs.llm.shared import keep
from lakejobs.session import scratch, stage, staging_path


@dataclass(frozen=True)
class GraphParams:
    """`shard` vectors in a graph, `degree` neighbours each (twice as many on the ground), beams from `beam` on.

    An audit compares the nearest nodes of `audit` vectors with all of the shard; below `recall`, beams double.
    Graphs of any size are searched first. Only after a beam has failed, by its audit or by holding nothing but
    links, does one that would be wider than an eighth of the shard give way to comparing with all of it.
    The work is dealt to at most `tasks` tasks.
    """

    least: float = 0.98
    shard: int = 4096
    degree: int = 16
    beam: int = 48
    audit: int = 64
    recall: float = 0.99
    tasks: int = 20_000
    seed: int = 11


class Graph:
    """A hierarchical navigable small-world graph over unit vectors, built in batches."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int):
        self.vectors, self.layers, self.entry = vectors, layers, entry

    @classmethod
    def build(cls, vectors: np.ndarray, params: GraphParams) -> Graph:
        n, m = len(vectors), params.degree
        draw = np.random.Generator(np.random.PCG64(params.seed))
        level = np.minimum((-np.log(1 - draw.random(n)) / np.log(m)).astype(int), 6)
        order = np.argsort(-level, kind="stable")
        layers = [np.full((n, 2 * m if k == 0 else m), -1, np.int32) for k in range(level.max() + 1 if n else 1)]
        graph = cls(vectors, layers, int(order[0]) if n else -1)
        done = 0
        while done < n:
            batch = order[done : done + (max(1, min(256, done)))]
            starts = np.full((len(batch), 1), graph.entry)
            for k in range(len(layers) - 1, -1, -1):
                rows = np.flatnonzero(level[batch] >= k)
                if done:
                    starts = graph._beam(vectors[batch], starts, params.beam if len(rows) else 4, k, 4)[0]
                if len(rows):
                    graph._link(batch[rows], starts[rows] if done else np.full((len(rows), 1), -1), k)
            done += len(batch)
        return graph

    def _link(self, nodes: np.ndarray, near: np.ndarray, k: int) -> None:
        """Give new nodes neighbours among `near` and each other, and the neighbours a way back."""
        layer = self.layers[k]
        own = self.vectors[nodes] @ self.vectors[nodes].T
        np.fill_diagonal(own, -2)
        top = np.argsort(-own, axis=1)[:, : min(16, len(nodes) - 1)]
        near = np.concatenate([near, nodes[top]], axis=1)
        chosen = self._select(nodes, near, layer.shape[1] // 2 if k == 0 else layer.shape[1])
        layer[nodes, : chosen.shape[1]] = chosen
        back_to, back_from = chosen.ravel(), np.repeat(nodes, chosen.shape[1])
        there = back_to >= 0
        back_to, back_from = back_to[there], back_from[there]
        order = np.argsort(back_to, kind="stable")
        back_to, back_from = back_to[order], back_from[order]
        targets, first, counts = np.unique(back_to, return_index=True, return_counts=True)
        if not len(targets):
            return
        fresh = np.full((len(targets), counts.max()), -1, np.int64)
        fresh[np.repeat(np.arange(len(targets)), counts), np.arange(len(back_to)) - np.repeat(first, counts)] = back_from
        pool = np.concatenate([layer[targets], fresh], axis=1)
        pruned = self._select(targets, pool, layer.shape[1])
        layer[targets] = -1
        layer[targets, : pruned.shape[1]] = pruned

    def _select(self, nodes: np.ndarray, pool: np.ndarray, most: int) -> np.ndarray:
        """Of each node's pool, the nearest that are nearer to it than to one chosen before; then the nearest left."""
        out = np.full((len(nodes), most), -1, np.int64)
        for low in range(0, len(nodes), 64):
            part = slice(low, low + 64)
            ids = np.sort(pool[part], axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            ids[ids == nodes[part, None]] = -1
            rows = np.arange(len(ids))[:, None]
            sims = np.einsum("bcd,bd->bc", self.vectors[ids], self.vectors[nodes[part]])
            sims[ids < 0] = -np.inf
            order = np.argsort(-sims, axis=1)[:, : 3 * most]
            ids, sims = ids[rows, order], sims[rows, order]
            between = np.einsum("bcd,bed->bce", self.vectors[ids], self.vectors[ids])
            taken = np.zeros(ids.shape, bool)
            for j in range(ids.shape[1]):
                close = np.where(taken, between[:, j], -np.inf).max(axis=1)
                taken[:, j] = (ids[:, j] >= 0) & (close < sims[:, j]) & (taken.sum(axis=1) < most)
            rank = np.argsort(np.where(taken, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
            out[part, : rank.shape[1]] = ids[rows, rank]
        return out

    def _beam(self, queries: np.ndarray, starts: np.ndarray, beam: int, k: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The `beam` nearest nodes found from `starts` in layer k, for all queries at once, nearest first."""
        layer, n = self.layers[k], len(self.vectors)
        count = len(queries)
        seen = np.zeros((count, n + 1), bool)
        seen[:, n] = True
        rows = np.arange(count)[:, None]

        def rated(row: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ids = np.sort(ids, axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            ids = np.where((ids >= 0) & ~seen[row[:, None], ids], ids, -1)
            seen[row[:, None], ids] = True
            sims = np.einsum("bcd,bd->bc", self.vectors[ids], queries[row])
            sims[ids < 0] = -np.inf
            return ids, sims

        ids, sims = rated(rows[:, 0], starts.astype(np.int64))
        open_ = ids >= 0
        active = rows[:, 0]
        while len(active):
            waiting = np.where(open_[active], sims[active], -np.inf)
            wide_now = min(wide, waiting.shape[1])
            best = np.argpartition(-waiting, wide_now - 1, axis=1)[:, :wide_now]
            useful = np.take_along_axis(waiting, best, axis=1) > -np.inf
            going = useful.any(axis=1)
            active, best, useful = active[going], best[going], useful[going]
            if not len(active):
                break
            nodes = np.where(useful, ids[active[:, None], best], -1)
            open_[active[:, None], best] = False
            around = np.where((nodes >= 0)[:, :, None], layer[nodes], -1).reshape(len(active), -1).astype(np.int64)
            more, more_sims = rated(active, around)
            width = min(beam, ids.shape[1] + more.shape[1])
            if width > ids.shape[1]:
                pad = width - ids.shape[1]
                ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
                sims = np.pad(sims, ((0, 0), (0, pad)), constant_values=-np.inf)
                open_ = np.pad(open_, ((0, 0), (0, pad)))
            all_ids = np.concatenate([ids[active], more], axis=1)
            all_sims = np.concatenate([sims[active], more_sims], axis=1)
            all_open = np.concatenate([open_[active], more >= 0], axis=1)
            top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[active] = np.take_along_axis(all_ids, top, axis=1)
            sims[active] = np.take_along_axis(all_sims, top, axis=1)
            open_[active] = np.take_along_axis(all_open, top, axis=1) & (ids[active] >= 0)
        order = np.argsort(-sims, axis=1)
        return ids[rows, order], sims[rows, order]

    def links(self, queries: np.ndarray, own: np.ndarray | None, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all links found. `own`: the queries' nodes, if they are in this graph."""
        found: list[np.ndarray] = []
        for low in range(0, len(queries), 256):
            rows = np.arange(low, min(low + 256, len(queries)))
            width = beam
            while len(rows):
                if 8 * width > len(self.vectors) and (width > beam or width >= len(self.vectors)):
                    sims = queries[rows] @ self.vectors.T
                    q, node = np.nonzero(sims >= least)
                    found.append(np.stack([rows[q], node]))
                    break
                starts = np.full((len(rows), 1), self.entry)
                for k in range(len(self.layers) - 1, 0, -1):
                    starts = self._beam(queries[rows], starts, 8, k)[0]
                if own is not None:
                    starts = np.concatenate([starts, own[rows, None]], axis=1)
                ids, sims = self._beam(queries[rows], starts, width, 0)
                good = (sims >= least) & (ids >= 0)
                # A beam that is nothing but links may have left some out.
                full = good.all(axis=1) & (good.shape[1] >= width)
                q, at = np.nonzero(good & ~full[:, None])
                found.append(np.stack([rows[q], ids[q, at]]))
                rows, width = rows[full], 4 * width
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pairs[0], pairs[1]

    def _found_nearest(self, queries: np.ndarray, own: np.ndarray | None, beam: int) -> np.ndarray:
        """The cosine of each query's nearest node that a beam finds, without the query's own node."""
        starts = np.full((len(queries), 1), self.entry)
        for k in range(len(self.layers) - 1, 0, -1):
            starts = self._beam(queries, starts, 8, k)[0]
        if own is not None:
            starts = np.concatenate([starts, own[:, None]], axis=1)
        ids, sims = self._beam(queries, starts, beam, 0)
        if own is not None:
            sims = np.where(ids == own[:, None], -np.inf, sims)
        return sims.max(axis=1)

    def audited(self, queries: np.ndarray, own: np.ndarray | None, params: GraphParams) -> tuple[np.ndarray, np.ndarray, float]:
        """Links, with beams wide enough for the audit, and the audit's recall of nearest nodes, whatever their cosine."""
        beam, n = params.beam, len(self.vectors)
        step = max(1, len(queries) // params.audit)
        sample = np.arange(0, len(queries), step)
        home = None if own is None else own[sample]
        truth = queries[sample] @ self.vectors.T
        if home is not None:
            truth[np.arange(len(sample)), home] = -np.inf
        nearest = truth.max(axis=1, initial=-np.inf)
        recall = 1.0
        while beam < n:
            recall = float((self._found_nearest(queries[sample], home, beam) >= nearest - 1e-9).mean()) if len(sample) else 0.0
            if recall >= params.recall:
                break
            beam, recall = (2 * beam if 16 * beam <= n else n), 1.0
        return *self.links(queries, own, params.least, beam), recall


def _classes(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Of n nodes, each one's smallest node that the links (a, b) connect it with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, label[a], low)
        np.minimum.at(fresh, label[b], low)
        np.minimum.at(fresh, a, low)
        np.minimum.at(fresh, b, low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def _unit_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, size, digest, vector): what can be linked; vectors as unit length doubles."""

    def norm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids, labels = batch.column("vec_id").to_pylist(), batch.column("label").to_pylist()
            for vec, label, value in zip(ids, labels, batch.column("embedding"), strict=True):
                size = digest = body = None
                if vec is not None and label is not None and value.is_valid and not value.values.null_count:
                    x = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    # Scaled first, so that no square leaves the range of doubles.
                    most = np.abs(x).max() if len(x) else 0.0
                    if 0 < most < np.inf:
                        x = x / most
                        body = (x / np.sqrt(x @ x)).tobytes()
                        size, digest = len(x), hashlib.blake2b(body, digest_size=16).hexdigest()
                out.append((vec, label, size, digest, body))
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.binary()]
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["vec_id", "label", "size", "digest", "vector"]
            )

    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    return plain.mapInArrow(norm, "vec_id long, label string, size int, digest string, vector binary")


def near_vectors(embeddings: DataFrame, params: GraphParams | None = None) -> DataFrame:
    """The rows of `near_vectors_audited`."""
    return near_vectors_audited(embeddings, params)[0]


def near_vectors_audited(embeddings: DataFrame, params: GraphParams | None = None) -> tuple[DataFrame, float]:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of equal label, not null, are linked at a cosine of `least` or more. Null vectors, zero ones,
    those with null or non-finite components and those of a null label or id have no links; vectors of
    different sizes have none with each other. `embeddings` needs `vec_id`, `embedding` and `label`; other
    columns are ignored. Equal vectors are searched for once. Rows that repeat a `vec_id` and its vector
    count once and each come out. A null `vec_id` has a null component and is kept.
    The second result is the audits' recall over all pieces of work, each weighed by its sample.
    """
    params = params or GraphParams()
    spark = embeddings.sparkSession
    group = ["label", "size"]
    with scratch(spark):
        folder = staging_path(spark, "graphs")
        rows = stage(_unit_vectors(embeddings), "vectors")
        usable = rows.filter("digest IS NOT NULL")
        nodes = stage(
            usable.groupBy(*group, "digest").agg(
                F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("copies"), F.any_value("vector").alias("vector")
            ),
            "vector-nodes",
        )
        shards = F.ceil(F.count("*") / params.shard).alias("shards")
        sized = nodes.join(nodes.groupBy(*group).agg(shards), group)
        dealt = sized.withColumn("shard", F.pmod(F.xxhash64("node", F.lit(params.seed)), F.col("shards")))

        def build(table: pa.Table) -> pa.Table:
            head = table.select(["label", "size", "shard", "shards"]).slice(0, 1)
            order = np.argsort(table.column("node").to_numpy())
            node, copies = (table.column(x).to_numpy()[order] for x in ("node", "copies"))
            vectors = np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in table.column("vector")])[order]
            graph = Graph.build(vectors, params)
            path = write_arrays(folder, "graph", [node, copies, vectors, *(x.astype(np.int64) for x in graph.layers)])
            head = head.append_column("path", pa.array([path], pa.string()))
            head = head.append_column("n", pa.array([len(node)], pa.int64()))
            head = head.append_column("layers", pa.array([len(graph.layers)], pa.int64()))
            return head.append_column("entry", pa.array([graph.entry], pa.int64()))

        schema = "label string, size int, shard long, shards long, path string, n long, layers long, entry long"
        built = stage(dealt.groupBy(*group, "shard").applyInArrow(build, schema), "vector-graphs")
        later = F.explode(F.sequence(F.col("shard"), F.col("shards") - 1))
        other = built.select(*group, F.col("shard").alias("with"), F.col("path").alias("path2"), F.col("n").alias("n2"))
        work = built.select("*", later.alias("with")).join(other, [*group, "with"])
        # One piece of work per pair of shards, few bytes each: a stated number of tasks, so that they are not put together.
        shards = built.groupBy(*group).agg(F.first("shards").alias("s")).agg(F.sum(F.expr("s * (s + 1) / 2"))).first()[0]
        work = work.repartition(max(1, min(int(shards or 0), params.tasks)))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield _search_piece(row, params)

        schema = "node long, links long, low long, asked long, recall double"
        pieces = stage(work.mapInArrow(search, schema), "vector-links")
        audit = pieces.agg(F.sum("asked").alias("asked"), F.sum(F.col("asked") * F.col("recall")).alias("hit")).first()
        found = pieces.filter("node IS NOT NULL")
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        edges = found.filter("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
        components = connected_components(edges)
        classes = (
            nodes.select(*group, "digest", "node", "copies")
            .join(counts, "node", "left")
            .join(components, "node", "left")
            .select(*group, "digest", F.coalesce("links", F.lit(0)).alias("links"), "copies", F.coalesce("component", "node").alias("low"))
        )
        joined = rows.drop("vector").join(classes, [*group, "digest"], "left")
        component = F.coalesce("low", "vec_id")
        result = keep(
            joined.select(
                "vec_id",
                F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
                component.alias("component_id"),
                F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
            ),
            "vector-classes",
        )
        return result, audit.hit / audit.asked if audit.asked else 1.0


def _search_piece(row: dict, params: GraphParams) -> pa.RecordBatch:
    """Links between two shards, or within one: per vector their number, and the smallest vector it is connected with here."""
    n, size, m = row["n"], row["size"], params.degree
    shapes = [(np.int64, n), (np.int64, n), (np.float64, n * size)] + [(np.int64, n * (2 * m if k == 0 else m)) for k in range(row["layers"])]
    node, copies, vectors, *layers = sections(row["path"], *shapes)
    graph = Graph(np.array(vectors).reshape(n, size), [np.array(x).reshape(n, -1) for x in layers], row["entry"])
    if row["shard"] == row["with"]:
        q, at, recall = graph.audited(graph.vectors, np.arange(n), params)
        code = np.unique(np.concatenate([q * n + at, at * n + q]))
        q, at = code // n, code % n
        q, at = q[q != at], at[q != at]
        links = np.bincount(q, weights=copies[at], minlength=n)
        ids = node
    else:
        n2 = row["n2"]
        node2, copies2, vectors2 = sections(row["path2"], (np.int64, n2), (np.int64, n2), (np.float64, n2 * size))
        q, at, recall = graph.audited(np.array(vectors2).reshape(n2, size), None, params)
        links = np.concatenate([np.bincount(at, weights=copies2[q], minlength=n), np.bincount(q, weights=copies[at], minlength=n2)])
        ids, q = np.concatenate([node, node2]), q + n
    # Places in order of the ids, so that the smallest label is the smallest id.
    order = np.argsort(ids)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    label = _classes(rank[q], rank[at], len(ids))
    there = np.flatnonzero(links > 0)
    low = ids[order][label[rank[there]]]
    asked = min(len(ids) if row["shard"] == row["with"] else row["n2"], params.audit)
    # After the vectors, one row for the audit.
    columns = [[*x.tolist(), None] for x in (ids[there], links[there].astype(np.int64), low)]
    empty = [None] * len(there)
    arrays = [*(pa.array(x, pa.int64()) for x in columns), pa.array([*empty, asked], pa.int64()), pa.array([*empty, recall], pa.float64())]
    return pa.RecordBatch.from_arrays(arrays, ["node", "links", "low", "asked", "recall"])
