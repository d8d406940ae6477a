import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from brute import alphanumeric
from lakejobs.llm import importance_resampling as module
from lakejobs.llm.importance_resampling import ResamplingParams, joined_words, resample
from lakejobs.llm.slots import SlotTable, _padded, hashes_of_length


def grams(text, params):
    words = alphanumeric(text)
    sizes = range(params.least, params.most + 1)
    return [" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)]


def expected(docs, target, params):
    def buckets(texts):
        return Counter(zlib.crc32(x.encode()) % params.buckets for text in texts for x in grams(text, params))

    s, t = buckets(text for _, text in docs), buckets(target)
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + params.buckets) / ((s[b] + 1) * (all_t + params.buckets))))

    rows = []
    for doc, text in docs:
        own = grams(text, params)
        weight = sum(gain(zlib.crc32(x.encode()) % params.buckets) for x in own)
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"{params.seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(own), weight, score, None, len(alphanumeric(text))])
    drawn = sorted((r for r in rows if r[0] is not None and r[5] >= params.min_words), key=lambda r: (-r[3], r[0]))
    for i, row in enumerate(drawn[: params.percent * len(drawn) // 100], 1):
        row[4] = i
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(docs, target, params):
    return sorted((tuple(r) for r in resample(docs, target, params).collect()), key=str)


@pytest.mark.parametrize("params", [ResamplingParams(), ResamplingParams(1, 3, 97, 5, 30)])
def test_documents(spark, sf_dir, real_texts, params):
    docs, target = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "benchmark"))
    want = expected(real_texts, [r.text for r in target.collect()], params)
    assert found(docs, target, params) == want and any(r[4] for r in want)


def test_odd_rows(spark, documents):
    long_text = "Größe über ÀÉ 日本語 " * 30_000 + "x" * 5_000
    rows = [(1, None), (2, ""), (3, "?!"), (4, "One two ONE"), (4, "One two ONE"), (None, "one two three"), (5, long_text), (6, "three " * 25)]
    rows += [(i, "same words every time here") for i in range(10, 40)]
    target = ["One and three", None, ""]
    params = ResamplingParams(1, 2, 50, 3, 50)
    docs = documents(rows, extra=("score", "rank", "bucket", "s", "n"))
    wanted = spark.createDataFrame([(x, 1) for x in target], "text string, t int")
    assert found(docs, wanted, params) == expected(rows, target, params)


def test_empty_tables(documents):
    assert resample(documents([]), documents(["a"])).collect() == []
    rows = found(documents(["a b", "c"]), documents([]), ResamplingParams(min_words=1, percent=100))
    assert rows == expected([(0, "a b"), (1, "c")], [], ResamplingParams(min_words=1, percent=100))


def test_texts_are_taken_in_parts_of_bounded_size(monkeypatch, documents):
    # The function that tasks run is the same; here it runs on the driver.
    monkeypatch.setattr(module, "_SLAB", 7)
    params = ResamplingParams(1, 3, 50)
    texts = pa.array(["a b c d e f g h i j", None, "a b c " * 20])
    total = Counter()
    for _, slots, table, buckets in module.interned(texts, params):
        assert len(slots) <= 7
        for slot in table.taken():
            total[buckets[slot]] += int(table.count[slot])
    assert total == Counter(zlib.crc32(x.encode()) % 50 for t in texts.to_pylist() for x in grams(t, params))


def test_hashes_are_xxhash64():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    for length in [*range(70), 127, 128, 129, 700]:
        starts = rng.integers(0, 4000, 9)
        want = [xxhash.xxh64_intdigest(data[s : s + length].tobytes()) for s in starts]
        assert hashes_of_length(_padded(data, starts, length), length).tolist() == want


def test_strings_of_one_hash_get_slots_of_their_own(monkeypatch):
    monkeypatch.setattr("lakejobs.llm.slots.hashes_of_length", lambda padded, length: np.zeros(len(padded), np.uint64))
    words = [b"aa", b"ab", b"aa", b"b", b"ab", b"aa", b"abcdefghij", b"abcdefghik"]
    ends = np.cumsum([len(x) for x in words])
    table = SlotTable(np.frombuffer(b"".join(words), np.uint8), ends - [len(x) for x in words], ends)
    assert {words[table.owner[s]]: int(table.count[s]) for s in table.taken()} == Counter(words)
    assert [words[table.owner[s]] for s in table.slots] == words


def test_joined_words():
    data, starts, ends, first = joined_words(pa.array(["Ab, c", None, "ÉÀ9"]))
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == ["ab", "c", "ÉÀ9"]
    assert data.tobytes().decode() == "ab c ÉÀ9 " and first.tolist() == [0, 2, 2, 3]
