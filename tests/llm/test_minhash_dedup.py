import random

import numpy as np
import pyarrow as pa
from brute import components, shingle_links
from lakejobs.llm import minhash_dedup
from lakejobs.llm.components import connected_components
from lakejobs.llm.minhash_dedup import MinMaxParams, _rest, _sets, _sketch, near_duplicates, parities


def result(df):
    return {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def expected(texts, width, percent=80):
    sets, links = shingle_links(texts, width, percent)
    low = components(sets, links)
    return {(x, len(sets[x]), low[x], low[x] == x) for x in sets}


def family(rng, copies, changes):
    base = [f"w{rng.randrange(900)}" for _ in range(100)]
    out = [" ".join(base)]
    for _ in range(copies):
        words = list(base)
        for at in rng.sample(range(100), changes):
            words[at] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_equals_brute_force(spark, documents, real_texts):
    for width in (4, 5):
        got = near_duplicates(documents(real_texts), MinMaxParams(width=width))
        assert result(got) == expected(real_texts, width)


def test_families_of_every_closeness(documents):
    rng = random.Random(3)
    texts = [text for changes in (1, 2, 3, 4, 5, 8) for text in family(rng, 30, changes)]
    rng.shuffle(texts)
    texts = list(enumerate(texts))
    got = near_duplicates(documents(texts), MinMaxParams(width=4))
    assert result(got) == expected(texts, 4)


def test_nodes_of_one_bucket_meet_by_their_rare_shingles(spark):
    """One bucket of many components: candidates grow with the nodes, and all links are found."""
    rng = np.random.default_rng(4)
    common = rng.integers(1, 1 << 60, 30)
    sets = []
    for i in range(400):
        own = np.unique(np.concatenate([common, rng.integers(1, 1 << 60, 70)]))
        sets += [(2 * i, own), (2 * i + 1, np.unique(np.concatenate([own[:-5], rng.integers(1, 1 << 60, 5)])))]
    shingles = spark.createDataFrame([(i, bytearray(x.astype(np.uint64).tobytes())) for i, x in sets], "node long, shingles binary")
    members = spark.createDataFrame([(1, i) for i, _ in sets], "key long, node long")
    none = spark.createDataFrame([], "a long, b long")
    links = _rest(members, none, none, shingles, MinMaxParams())
    assert sorted((r.a, r.b) for r in links.collect()) == [(2 * i + 1, 2 * i) for i in range(400)]


def test_parities_never_exceed_what_sets_differ_in():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(1, 400, size).astype(np.uint64)) for size in (0, 1, 5, 50, 150, 150, 300, 3000)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    found = parities(np.concatenate(sets), bounds)
    bits = np.unpackbits(found.view(np.uint8), axis=1)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            differing = len(np.setxor1d(a, b))
            unlike = int((bits[i] != bits[j]).sum())
            assert unlike <= differing and (differing - unlike) % 2 == 0 and (differing != 1 or unlike == 1)


def test_a_large_family_at_the_limit(documents):
    """Copies of one text whose similarity lies on both sides of the limit, most of them unlinked with one another."""
    rng = random.Random(8)
    texts = [text for changes in (3, 4, 5, 6) for text in family(random.Random(9), 1, 0)[:1] + family(rng, 60, changes)]
    base = texts[0].split()
    for changes in (3, 4, 5, 6):
        for _ in range(60):
            words = list(base)
            for at in rng.sample(range(100), changes):
                words[at] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts = list(enumerate(texts))
    assert result(near_duplicates(documents(texts), MinMaxParams(width=4))) == expected(texts, 4)


def test_texts_are_shuffled_when_ids_are_many(documents):
    texts = list(enumerate(family(random.Random(5), 20, 2)))
    got = near_duplicates(documents(texts), MinMaxParams(width=4, broadcast_ids=3))
    assert result(got) == expected(texts, 4)


def test_odd_rows(documents):
    long = " ".join(f"t{i % 70000}" for i in range(200_000))
    rows = [(5, None), (1, ""), (2, " \t\n"), (3, "One TWO"), (4, "one two"), (9, long), (8, long), (8, long), (None, "one two")]
    got = sorted(near_duplicates(documents(rows, extra=["keys", "n", "digest"]), MinMaxParams(width=4)).collect(), key=str)
    seen = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got]
    words = long.split()
    n = len({tuple(words[i : i + 4]) for i in range(len(words) - 3)})
    assert sorted(seen, key=str) == sorted(
        [
            (5, 0, 5, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False),
            (9, n, 8, False), (8, n, 8, True), (8, n, 8, True), (None, 1, None, True),
        ],
        key=str,
    )


def test_empty_table(documents):
    assert near_duplicates(documents([])).collect() == []


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1200)]
    links += [(2000, 2000 + i) for i in range(1, 300)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == components({x for pair in real for x in pair}, real)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_workers_look_at_a_megabyte_of_text_at_once(monkeypatch):
    """Arrays over text take many times its bytes; what comes out does not depend on how it is divided."""

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    seen = []

    def counted(texts, width, whole=minhash_dedup.document_sets):
        seen.append(sum(len(x) for x in texts.to_pylist()))
        return whole(texts, width)

    monkeypatch.setattr(minhash_dedup, "document_sets", counted)
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(9000)}" for _ in range(12_000)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    for work in (_sketch, _sets):
        run = work(Docs(), MinMaxParams())
        seen.clear()
        got = pa.Table.from_batches(run([batch]))
        assert sum(seen) == sum(map(len, texts)) > 3 << 20 and max(seen) <= 1 << 20
        single = pa.Table.from_batches(x for i in range(60) for x in run([batch.slice(i, 1)]))
        assert got.to_pylist() == single.to_pylist()
