import numpy as np
import pytest
from brute import components
from lakejobs.llm.embedding_dedup import Graph, GraphParams, near_vectors


def expected(rows):
    """From (vec_id, embedding, label)."""
    ids = [i for i, _, _ in rows]
    links = []
    unit = {}
    for at, (i, x, label) in enumerate(rows):
        if x is not None and label is not None and None not in x and np.isfinite(x).all() and np.any(x):
            v = np.array(x, float)
            unit[at] = v / np.abs(v).max()
            unit[at] = unit[at] / np.linalg.norm(unit[at])
    for a in unit:
        for b in unit:
            if ids[a] < ids[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98:
                links.append((ids[a], ids[b]))
    low = components(set(ids), links)
    count = {i: 0 for i in ids}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return sorted((i, count[i], low[i], low[i] == i) for i in ids)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def clouds(seed, groups, each, dims, noise, labels):
    draw = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = draw.normal(size=dims)
        centre /= np.linalg.norm(centre)
        for _ in range(each):
            rows.append([(centre + draw.normal(size=dims) * noise).astype("float32").tolist(), g % labels])
    draw.shuffle(rows)
    return [(i, x, label) for i, (x, label) in enumerate(rows)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shard", [4096, 60])
@pytest.mark.parametrize(("groups", "each", "noise"), [(150, 2, 0.012), (4, 75, 0.012), (30, 10, 0.02)])
def test_equals_brute_force(spark, shard, groups, each, noise):
    """Pairs, large groups and chains; in one shard and over several."""
    rows = clouds(5, groups, each, 64, noise, 3)
    df = spark.createDataFrame([(i, x, label) for i, x, label in rows], SCHEMA).selectExpr("*", "1 AS shard", "2 AS node")
    assert result(near_vectors(df, GraphParams(shard=shard))) == expected(rows)


def test_test_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    assert result(near_vectors(df)) == expected([tuple(r) for r in df.collect()])


def test_graph_finds_links_without_looking_at_all():
    rows = clouds(9, 1500, 2, 64, 0.01, 1)
    vectors = np.array([x for _, x, _ in rows])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    params = GraphParams()
    graph = Graph.build(vectors, params)
    truth = {(a, b) for a, b in zip(*np.nonzero(vectors @ vectors.T >= 0.98))}
    # As members, which start from their own place, and as strangers.
    q, node = graph.links(vectors, np.arange(len(vectors)), 0.98, params.beam)
    assert len(truth & set(zip(q.tolist(), node.tolist()))) >= 0.98 * len(truth)
    q, node, recall = graph.audited(vectors, None, params)
    assert recall >= 0.9 and len(truth & set(zip(q.tolist(), node.tolist()))) >= 0.9 * len(truth)


def test_odd_rows(spark):
    one, two = [1.0, 0.0, 0.5], [2.0, 0.0, 1.0]
    rows = [
        (9, one, 1), (3, two, 1), (5, one, 2), (6, one, None), (7, None, 1), (8, [0.0, 0.0, 0.0], 1), (10, [1.0, None, 0.5], 1),
        (11, [float("nan"), 0.0, 0.5], 1), (12, [float("inf"), 0.0, 0.5], 1), (13, [1.0, 0.0], 1), (14, [2.0, 0.0], 1), (15, [], 1),
        (16, [1e-40, 0.0, 5e-41], 1), (17, [3e38, 0.0, 1.5e38], 1),
    ]
    got = result(near_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert got == [
        (3, 3, 3, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 3, 3, False), (10, 0, 10, True),
        (11, 0, 11, True), (12, 0, 12, True), (13, 1, 13, True), (14, 1, 13, False), (15, 0, 15, True), (16, 3, 3, False), (17, 3, 3, False),
    ]
    twice = spark.createDataFrame([(1, one, 1), (1, one, 1), (2, one, 1), (None, one, 1)], SCHEMA)
    assert sorted(map(str, result_any(near_vectors(twice)))) == sorted(map(str, [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)]))
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def result_any(df):
    return [tuple(r) for r in df.collect()]


def test_audit_sees_broken_navigation_without_links_in_its_sample():
    """Few links across shards, and a graph that leads nowhere: the beam has to give way to the full comparison."""
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(3000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = Graph(vectors, [np.full((3000, 32), -1, np.int32)], 0)
    others = draw.normal(size=(3000, 16))
    others /= np.linalg.norm(others, axis=1, keepdims=True)
    others[1] = vectors[77]
    truth = set(zip(*np.nonzero(others @ vectors.T >= 0.98)))
    q, node, _ = graph.audited(others, None, GraphParams())
    assert (1, 77) in truth and set(zip(q.tolist(), node.tolist())) == truth
    q, node, _ = graph.audited(vectors, np.arange(3000), GraphParams())
    assert set(zip(q.tolist(), node.tolist())) == set(zip(*np.nonzero(vectors @ vectors.T >= 0.98)))


def test_small_labels_are_searched_by_their_graphs(spark, monkeypatch):
    """Of the test table, no audit fails, so that no beam gives way to comparing with all."""
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect() if r.label == 1 and r.embedding]
    vectors = np.array([r.embedding for r in rows], float)
    vectors = np.unique(vectors / np.linalg.norm(vectors, axis=1, keepdims=True), axis=0)
    graph = Graph.build(vectors, GraphParams())
    beams = []
    inner = Graph._beam
    monkeypatch.setattr(Graph, "_beam", lambda self, queries, starts, width, layer: beams.append(width) or inner(self, queries, starts, width, layer))
    q, node, recall = graph.audited(vectors, np.arange(len(vectors)), GraphParams())
    assert GraphParams().beam in beams and recall >= 0.9
    assert set(zip(q.tolist(), node.tolist())) == {(a, b) for a, b in zip(*np.nonzero(vectors @ vectors.T >= 0.98))}


def test_pieces_are_dealt_to_tasks_and_graphs_deleted(spark):
    from pathlib import Path

    from lakejobs.session import shared_dir

    rows = clouds(3, 30, 10, 16, 0.02, 3)
    here = Path(shared_dir(spark)) / "lakejobs" / spark.sparkContext.applicationId
    before = {x.name for x in here.glob("*")} if here.exists() else set()
    near_vectors(spark.createDataFrame(rows, SCHEMA), GraphParams(shard=20)).collect()
    left = {x.name.split("-")[0] for x in here.glob("*") if x.name not in before}
    assert "graphs" not in left and len(left) == 1
