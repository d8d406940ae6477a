import hashlib

import lakejobs.llm.decontamination as module
import pytest
from brute import alphanumeric
from lakejobs.llm.decontamination import find_passages

LONG = " ".join(f"Alpha{i}" for i in range(14))
ITEMS = [(1, LONG), (2, "Short item"), (3, None), (4, "?!"), (5, LONG), (None, "null id here"), (6, "short Item"), (2, "other")]
DOCS = [
    (0, None),
    (1, ""),
    (2, "x " + LONG.upper() + " y"),
    (3, "ALPHA0 alpha1 alpha2"),
    (4, "a short, item! b short item short item"),
    (5, "naïve " + " ".join(LONG.split()[3:13]) + " été"),
    (6, "null id here"),
    (7, "a short, item! b short item short item"),
    (7, "a short, item! b short item short item"),
    (None, "other"),
    (8, ("word " * 30_000) + LONG),
]


def plain(docs, items, window=10):
    grams, sizes = {}, set()
    for item, text in items:
        words = alphanumeric(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n and item is not None else 0):
            grams.setdefault(tuple(words[i : i + n]), set()).add(str(item))
            sizes.add(n)
    out = []
    for doc, text in docs:
        words, hit, names = alphanumeric(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if found := grams.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(x) for x in df.drop("hits", "items").collect()), key=str)


@pytest.mark.parametrize("limit", [200_000, 2])
def test_equals_brute_force(spark, documents, real_texts, sf_dir, monkeypatch, limit):
    """On both ways: windows sent to all, and both sides shuffled."""
    monkeypatch.setattr(module, "BROADCAST_WINDOWS", limit)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(find_passages(documents(DOCS, extra=["w", "items"]), items)) == plain(DOCS, ITEMS)
    table = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert rows(find_passages(documents(real_texts), table)) == plain(real_texts, [tuple(x) for x in table.select("item_id", "text").collect()])


def test_spans_join(spark, documents):
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    found = find_passages(documents(["x " + LONG + " y " + LONG]), items).first()
    assert [tuple(x) for x in found.hits] == [(2, 16), (17, 31)]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(find_passages(documents(["a b"]), none)) == plain([(0, "a b")], [])
    assert rows(find_passages(documents([]), spark.createDataFrame(ITEMS, "item_id long, text string"))) == []


def test_no_python_in_the_plan(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = find_passages(documents(DOCS), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan
