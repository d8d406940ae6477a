import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import spaced
from lakejobs.llm.ngram_lm import LmParams, _discounts, _packed, _unpacked, score_texts, train_lm

END, BEGIN = object(), object()


def is_held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class Plain:
    """The same model from dictionaries."""

    def __init__(self, rows):
        self.tokens, self.pairs = Counter(), Counter()
        for doc, text in rows:
            if not is_held_out(doc):
                words = [*spaced(text), END]
                self.tokens.update(words)
                self.pairs.update(zip([BEGIN, *words], words))
        self.total = sum(self.tokens.values())
        self.after = Counter(w for _, w in self.pairs)
        self.follow = defaultdict(list)
        for (u, _), c in self.pairs.items():
            self.follow[u].append(c)
        self.d2 = self.discounts(self.pairs.values())
        self.d1 = self.discounts(self.after.values())
        self.kinds = sum(self.after.values())
        self.left = sum(self.d1[min(c, 3)] for c in self.after.values()) / max(1, self.kinds)
        self.spare = {u: (sum(counts), sum(self.d2[min(x, 3)] for x in counts)) for u, counts in self.follow.items()}

    @staticmethod
    def discounts(counts):
        of = Counter(counts)
        n = [of[i] for i in (1, 2, 3, 4)]
        if not all(n):
            return [0, 0.5, 0.75, 0.9]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        return [0, *(min(max(x, 0.1), top) for x, top in zip(raw, (0.99, 1.99, 2.99)))]

    def one(self, w):
        even = 1 / (len(self.tokens) + 1)
        if not self.kinds:
            return even
        c = self.after[w]
        return (c - self.d1[min(c, 3)]) / self.kinds + self.left * even

    def two(self, u, w):
        if u not in self.spare:
            return self.one(w)
        total, spare = self.spare[u]
        c = self.pairs[u, w]
        return (c - self.d2[min(c, 3)] + spare * self.one(w)) / total

    def row(self, doc, text):
        words = [*spaced(text), END]
        base = sum(math.log10((self.tokens[w] + 1) / (self.total + len(self.tokens) + 1)) for w in words)
        score = sum(math.log10(self.two(u, w)) for u, w in zip([BEGIN, *words], words))
        return (doc, is_held_out(doc), len(words), sum(w in self.tokens for w in words), self.total, base, score)


def check(df, rows):
    model = Plain(rows)
    got = sorted((tuple(r)[:7] for r in df.collect()), key=str)
    want = sorted((model.row(*row) for row in rows), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    return model


@pytest.mark.parametrize("params", [LmParams(), LmParams(part_bytes=20_000, flush=500)])
def test_equals_plain_model(documents, real_texts, params):
    """In one part, and over many with frequent hand-overs and tokens counted in several parts."""
    docs = documents(real_texts, extra=["body", "part"])
    model = train_lm(docs, params)
    assert (len(model.token_files) > 10 and len(model.spread.hot) > 0) == (params.flush == 500)
    plain = check(score_texts(docs, model), real_texts)
    # All tokens and one unknown one sum up to one behind any token.
    for u in [BEGIN, END, *random.Random(1).sample([w for w in plain.tokens if w is not END], 5)]:
        assert sum(plain.two(u, w) for w in [*plain.tokens, object()]) == pytest.approx(1)


def test_odd_rows(documents):
    rows = [(1, None), (2, ""), (2, ""), (None, "a B b"), (3, " \x0b\t "), (4, "a " * 100_000), (5, "İ ß é x"), (6, "A b")]
    docs = documents(rows)
    check(score_texts(docs, train_lm(docs)), rows)
    assert score_texts(documents([]), train_lm(docs)).collect() == []


def test_nothing_to_learn_from(documents):
    held = [next(i for i in range(100) if is_held_out(i))]
    rows = [(held[0], "a b")]
    docs = documents(rows)
    check(score_texts(docs, train_lm(docs)), rows)


def test_seen_order_is_likelier(documents):
    rows = [(i, "the cat sat on the mat and the dog sat on the rug") for i in range(30)]
    model = train_lm(documents(rows))
    good, bad = (r.perplexity for r in score_texts(documents([(1, rows[0][1]), (2, "rug mat the dog the on cat sat and sat on the the")]), model).orderBy("doc_id").collect())
    assert good < bad / 3


def test_packed_counts_come_back():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000, np.uint64) * np.uint64(2))
    counts = np.arange(1, len(keys) + 1)
    a, b = _unpacked(_packed(keys, counts))
    assert (a == keys).all() and (b == counts).all()
    assert _discounts(np.array([100, 50, 20, 10]))[1] == pytest.approx(0.5)
