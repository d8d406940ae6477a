"""A bigram language model with interpolated modified Kneser-Ney smoothing, counted in Spark.

The model is a set of files in the shared folder, none larger than a part of the counts:

* tokens: sorted 64-bit hashes, counts; a token's number is its place in all of these files
* bigrams: sorted keys (first token's number, second token's number) with counts, and per first token how
  often it occurs before another one, and before how many different ones (once, twice, more often)
* continuations: of each token, after how many different ones it occurs

Tasks count what they read before anything is shuffled; each part is then merged in one task, which
writes its file and returns the file's name and a few sums. Only these come to the driver. Workers map
the files into memory to score texts; of a store that is not a file system, they map copies.
A token that stands before a large share of all others is counted in several parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.files import sections, write_arrays
from lakejobs.llm.shared import chunks, text_bytes
from lakejobs.llm.words import SPACED, hashes, mix, spans
from lakejobs.session import fresh_path, scratch, stage

_END = np.uint64(0x5EED0FE2D0C5E3D1)
_ID_BITS = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class LmParams:
    """Rows with `crc32(doc_id as text) mod held_out_of = held_out` are not learned from.

    `part_bytes` of text make one part of the counts, which one task merges in memory; `flush` is how many
    different keys a task holds before it hands them over.
    """

    held_out_of: int = 7
    held_out: int = 2
    part_bytes: int = 24 << 20
    flush: int = 2_000_000


def held_out(doc_id: Column, params: LmParams) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % params.held_out_of == params.held_out, F.lit(False))


# --- counting ---------------------------------------------------------------------------------------


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and one end, one text after the other, and where each text's start."""
    data, offsets = text_bytes(texts)
    starts, ends, first = spans(data, offsets, SPACED)
    bounds = first + np.arange(len(first))
    tokens = np.full(bounds[-1], _END, np.uint64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    tokens[np.arange(len(starts)) + text] = hashes(data, starts, ends)
    return tokens, bounds


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, sorted, with the sum of its counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, and counts, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    # Bytes of one rank stand together: high ones are mostly zero, and so are those of counts.
    planes = [x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in (steps, counts.astype(np.int64))]
    return len(keys).to_bytes(8, "little") + zstandard.compress(b"".join(planes), 1)


def _unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(body[:8], "little")
    planes = np.frombuffer(zstandard.decompress(body[8:], max_output_size=16 * n), np.uint8).reshape(2, 8, n)
    steps, counts = (np.ascontiguousarray(x.T).view(kind).ravel() for x, kind in zip(planes, (np.uint64, np.int64)))
    return np.cumsum(steps, dtype=np.uint64), counts


class _Counter:
    """Counts of keys, merged when they grow beyond `flush`."""

    def __init__(self, flush: int):
        self.flush, self.parts, self.size = flush, [], 0

    def add(self, keys: np.ndarray) -> bool:
        unique, counts = np.unique(keys, return_counts=True)
        self.parts.append((unique, counts.astype(np.int64)))
        self.size += len(unique)
        if self.size > 2 * self.flush:
            self.parts = [self.take()]
            self.size = len(self.parts[0][0])
        return self.size > self.flush

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([x for x, _ in self.parts] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([x for _, x in self.parts] or [np.zeros(0, np.int64)])
        self.parts, self.size = [], 0
        return merged(keys, counts)


def _dealt(keys: np.ndarray, counts: np.ndarray, part: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        body = _packed(keys[rows], counts[rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(part[rows[0]])], pa.int32()), pa.array([body], pa.binary())], ["part", "body"]
        )


def _token_part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Parts of tokens are ranges of their hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


@dataclass(frozen=True)
class _Spread:
    """Where bigrams are counted: by their first token, in several parts for those of a large share."""

    parts: int
    hot: np.ndarray
    split: np.ndarray

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        part = mix(first.astype(np.uint64)) % np.uint64(self.parts)
        if len(self.hot):
            place = np.minimum(np.searchsorted(self.hot, first), len(self.hot) - 1)
            split = np.where(self.hot[place] == first, self.split[place], 1).astype(np.uint64)
            part = (part + mix(second.astype(np.uint64)) % split) % np.uint64(self.parts)
        return part.astype(np.int64)

    def is_hot(self, first: np.ndarray) -> np.ndarray:
        return np.isin(first, self.hot)


# --- the model --------------------------------------------------------------------------------------


def _discounts(of: np.ndarray) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and more, from how many keys have the counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in of[:4])
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    found = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(found, [0, 0.1, 0.1, 0.1], [0, 0.99, 1.99, 2.99])


@dataclass(frozen=True)
class LmModel:
    """Names and sizes of the model's files, and the sums that hold for all of them."""

    train_tokens: int
    vocabulary: int
    token_files: list[tuple[str, int]]
    bases: np.ndarray
    pair_files: list[tuple[str, int, int, int] | None]
    next_files: list[str | None]
    spread: _Spread
    hot_stats: np.ndarray
    pair_discounts: np.ndarray
    next_discounts: np.ndarray
    next_total: int
    next_kinds: np.ndarray
    params: LmParams = field(default_factory=LmParams)

    @property
    def begin(self) -> int:
        """The number that stands before a text's first token."""
        return self.vocabulary

    def numbers(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of sorted distinct tokens; -1 and 0 for unknown ones."""
        ids, counts = np.full(len(tokens), -1, np.int64), np.zeros(len(tokens), np.int64)
        part = _token_part(tokens, len(self.token_files))
        for p in np.unique(part).tolist():
            path, n = self.token_files[p]
            if not n:
                continue
            rows = slice(*np.searchsorted(part, [p, p + 1]))
            keys, seen = sections(path, (np.uint64, n), (np.int64, n))
            place = np.minimum(np.searchsorted(keys, tokens[rows]), n - 1)
            there = keys[place] == tokens[rows]
            ids[rows] = np.where(there, place + self.bases[p], -1)
            counts[rows] = np.where(there, seen[place], 0)
        return ids, counts

    def continuations(self, ids: np.ndarray) -> np.ndarray:
        """Of sorted numbers (unknown ones first), after how many different tokens they occur."""
        out = np.zeros(len(ids), np.int64)
        part = np.searchsorted(self.bases, ids, "right") - 1
        for p in np.unique(part[ids >= 0]).tolist():
            if (path := self.next_files[p]) is not None:
                rows = (part == p) & (ids >= 0)
                (counts,) = sections(path, (np.int64, self.token_files[p][1]))
                out[rows] = counts[ids[rows] - self.bases[p]]
        return out

    def _by_part(self, part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(part, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
            yield int(part[rows[0]]), rows

    def _pair_file(self, p: int):
        found = self.pair_files[p]
        if found is None:
            return None
        path, n, m, k = found
        shapes = [(np.uint64, n), (np.int64, m), (np.int64, m), (np.int64, k), (np.int64, k), (np.int64, 3 * k), (np.uint8, n)]
        return sections(path, *shapes)

    def pair_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), np.int64)
        wanted = first.astype(np.uint64) << _ID_BITS | second.astype(np.uint64)
        for p, rows in self._by_part(self.spread.of(first, second)):
            if (file := self._pair_file(p)) is None or not len(file[0]):
                continue
            keys, over_at, over, _, _, _, counts = file
            place = np.minimum(np.searchsorted(keys, wanted[rows]), len(keys) - 1)
            count = np.where(keys[place] == wanted[rows], counts[place], 0).astype(np.int64)
            large = np.flatnonzero(count == 255)
            count[large] = over[np.searchsorted(over_at, place[large])]
            out[rows] = count
        return out

    def contexts(self, first: np.ndarray) -> np.ndarray:
        """Per first token: total, and how many different tokens follow once, twice, more often."""
        out = np.zeros((len(first), 4))
        hot = self.spread.is_hot(first)
        if hot.any():
            place = np.searchsorted(self.hot_stats[:, 0], first[hot])
            out[hot] = self.hot_stats[np.minimum(place, len(self.hot_stats) - 1), 1:]
        cold = np.flatnonzero(~hot)
        for p, rows in self._by_part(self.spread.of(first[cold], first[cold])):
            if (file := self._pair_file(p)) is None or not len(file[3]):
                continue
            ids, total, kinds = file[3], file[4], file[5].reshape(3, -1)
            rows = cold[rows]
            place = np.minimum(np.searchsorted(ids, first[rows]), len(ids) - 1)
            there = ids[place] == first[rows]
            out[rows, 0] = np.where(there, total[place], 0)
            out[rows, 1:] = np.where(there, kinds[:, place], 0).T
        return out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: tokens, known ones, the base score and the model's log10 probability."""
        tokens, bounds = tokens_of(texts)
        unique, back = np.unique(tokens, return_inverse=True)
        ids, counts = self.numbers(unique)
        low = np.log10((counts + 1) / (self.train_tokens + self.vocabulary + 1))
        # Unigrams: continuations, with what is taken from them spread evenly over the vocabulary and one more.
        order = np.argsort(ids, kind="stable")
        after = np.empty(len(ids))
        after[order] = self.continuations(ids[order])
        even = 1 / (self.vocabulary + 1)
        if self.next_total:
            taken = self.next_discounts[np.minimum(after, 3).astype(int)]
            left = float(self.next_discounts[1:] @ self.next_kinds) / self.next_total
            single = (after - taken) / self.next_total + left * even
        else:
            single = np.full(len(ids), even)

        number = ids[back]
        before = np.empty(len(number), np.int64)
        if len(number):
            before[1:] = number[:-1]
            before[bounds[:-1]] = self.begin
        p = single[back]
        if self.vocabulary:
            firsts, at = np.unique(before, return_inverse=True)
            stats = self.contexts(np.where(firsts < 0, 0, firsts))
            stats[firsts < 0] = 0
            total = stats[:, 0][at]
            spare = (stats[:, 1:] @ self.pair_discounts[1:])[at]
            known = np.flatnonzero((total > 0) & (number >= 0))
            pairs, again = np.unique(before[known].astype(np.uint64) << _ID_BITS | number[known].astype(np.uint64), return_inverse=True)
            seen = np.zeros(len(number))
            seen[known] = self.pair_counts((pairs >> _ID_BITS).astype(np.int64), (pairs & _LOW).astype(np.int64))[again]
            seen -= self.pair_discounts[np.minimum(seen, 3).astype(int)]
            there = total > 0
            p[there] = (seen[there] + spare[there] * p[there]) / total[there]
        first = bounds[:-1]
        sums = [np.add.reduceat(x, first) if len(first) else np.zeros(0) for x in (low[back], np.log10(p), (counts > 0)[back].astype(np.int64))]
        return np.diff(bounds), sums[2], sums[0], sums[1]




def train_lm(docs: DataFrame, params: LmParams | None = None) -> LmModel:
    """Count tokens and bigrams of all rows that are not held out, and write the model's files.

    The model's folder stays until someone deletes it, as workers map it. Up to 2**32 - 1 different tokens.
    """
    params = params or LmParams()
    spark = docs.sparkSession
    folder = fresh_path(spark, "lm-model")
    texts = docs.filter(~held_out(F.col("doc_id"), params)).select("text")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-int(size) // params.part_bytes))

    def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(params.flush)
        for batch in batches:
            for part in chunks(batch, "text"):
                if counter.add(tokens_of(part.column("text"))[0]):
                    keys, counts = counter.take()
                    yield from _dealt(keys, counts, _token_part(keys, parts))
        keys, counts = counter.take()
        yield from _dealt(keys, counts, _token_part(keys, parts))

    def gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        pairs = [_unpacked(x.as_py()) for x in table.column("body")]
        return merged(np.concatenate([x for x, _ in pairs]), np.concatenate([x for _, x in pairs]))

    def write_tokens(table: pa.Table) -> pa.Table:
        keys, counts = gathered(table)
        path = write_arrays(folder, f"tokens-{table.column('part')[0]}", [keys, counts])
        top = np.argsort(counts)[-64:]
        return pa.table(
            {
                "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
                "path": [path],
                "n": pa.array([len(keys)], pa.int64()),
                "total": pa.array([int(counts.sum())], pa.int64()),
                "top": pa.array([top.tolist()], pa.list_(pa.int64())),
                "top_counts": pa.array([counts[top].tolist()], pa.list_(pa.int64())),
            }
        )

    schema = "part int, path string, n long, total long, top array<long>, top_counts array<long>"
    with scratch(spark):
        dealt = texts.mapInArrow(count_tokens, "part int, body binary")
        told = stage(dealt.groupBy("part").applyInArrow(write_tokens, schema), "lm-tokens").toArrow().to_pylist()
        token_files = [("", 0)] * parts
        for row in told:
            token_files[row["part"]] = (row["path"], row["n"])
        bases = np.concatenate([[0], np.cumsum([n for _, n in token_files])])[:-1].astype(np.int64)
        vocabulary, train_tokens = (sum(row[name] for row in told) for name in ("n", "total"))
        if vocabulary >= 1 << 32:
            raise ValueError("more different tokens than a bigram's key can number")
        # Tokens that would fill more than a quarter of a part: no more than four times the parts.
        share = max(1, train_tokens // (4 * parts))
        hot = {int(bases[row["part"]]) + at: c for row in told for at, c in zip(row["top"], row["top_counts"]) if c > share}
        starts = texts.count()
        if starts > share:
            hot[vocabulary] = starts
        ids = np.array(sorted(hot), np.int64)
        split = np.array([min(parts, -(-hot[i] // share)) for i in ids.tolist()], np.int64)
        spread = _Spread(parts, ids, split)
        kinds = np.zeros(4)
        model = LmModel(
            train_tokens, vocabulary, token_files, bases, [None] * parts, [None] * parts, spread,
            np.zeros((0, 5)), kinds, kinds, 0, kinds[1:], params,
        )
        if not vocabulary:
            return model

        def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counter = _Counter(params.flush)

            def flush() -> Iterator[pa.RecordBatch]:
                keys, counts = counter.take()
                yield from _dealt(keys, counts, spread.of((keys >> _ID_BITS).astype(np.int64), (keys & _LOW).astype(np.int64)))

            for batch in batches:
                for part in chunks(batch, "text"):
                    tokens, bounds = tokens_of(part.column("text"))
                    unique, back = np.unique(tokens, return_inverse=True)
                    number = model.numbers(unique)[0][back].astype(np.uint64)
                    before = np.empty(len(number), np.uint64)
                    before[1:] = number[:-1]
                    before[bounds[:-1]] = vocabulary
                    if counter.add(before << _ID_BITS | number):
                        yield from flush()
            yield from flush()

        def write_pairs(table: pa.Table) -> pa.Table:
            part = table.column("part")[0].as_py()
            keys, counts = gathered(table)
            first = (keys >> _ID_BITS).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
            own = first[cuts]
            total = np.add.reduceat(counts, cuts)
            follow = np.stack([np.add.reduceat((x).astype(np.int64), cuts) for x in (counts == 1, counts == 2, counts > 2)])
            shared = spread.is_hot(own)
            over = np.flatnonzero(counts >= 255)
            cold = ~shared
            path = write_arrays(
                folder,
                f"pairs-{part}",
                [keys, over.astype(np.int64), counts[over], own[cold], total[cold], follow[:, cold], np.minimum(counts, 255).astype(np.uint8)],
            )
            second, after = np.unique(keys & _LOW, return_counts=True)
            home = np.searchsorted(bases, second.astype(np.int64), "right") - 1
            bodies = list(_dealt(second, after.astype(np.int64), home))
            n = len(bodies) + 1
            stats = np.column_stack([own[shared], total[shared], follow[:, shared].T]).ravel().tolist()
            return pa.table(
                {
                    "part": pa.array([part, *(x.column("part")[0].as_py() for x in bodies)], pa.int32()),
                    "path": pa.array([path] + [None] * (n - 1), pa.string()),
                    "sizes": pa.array([[len(keys), len(over), int(cold.sum())]] + [None] * (n - 1), pa.list_(pa.int64())),
                    "kinds": pa.array([[int((counts == i).sum()) for i in (1, 2, 3, 4)]] + [None] * (n - 1), pa.list_(pa.int64())),
                    "hot": pa.array([stats] + [None] * (n - 1), pa.list_(pa.int64())),
                    "body": pa.array([None, *(x.column("body")[0].as_py() for x in bodies)], pa.binary()),
                }
            )

        schema = "part int, path string, sizes array<long>, kinds array<long>, hot array<long>, body binary"
        dealt = texts.mapInArrow(count_pairs, "part int, body binary")
        counted = stage(dealt.groupBy("part").applyInArrow(write_pairs, schema), "lm-pairs")
        told = counted.filter("path IS NOT NULL").drop("body").toArrow().to_pylist()
        pair_files: list = [None] * parts
        for row in told:
            pair_files[row["part"]] = (row["path"], *row["sizes"])
        stats = np.array([x for row in told for x in row["hot"]], float).reshape(-1, 5)
        hot_stats = np.array([[i, *stats[stats[:, 0] == i, 1:].sum(axis=0)] for i in ids.tolist()], float).reshape(-1, 5)
        pair_discounts = _discounts(np.sum([row["kinds"] for row in told], axis=0))

        def write_next(table: pa.Table) -> pa.Table:
            part = table.column("part")[0].as_py()
            keys, counts = gathered(table)
            whole = np.zeros(token_files[part][1], np.int64)
            whole[keys.astype(np.int64) - bases[part]] = counts
            kinds = [int((counts == i).sum()) for i in (1, 2, 3, 4)] + [int((counts > 2).sum()), int(counts.sum())]
            return pa.table(
                {
                    "part": pa.array([part], pa.int32()),
                    "path": [write_arrays(folder, f"next-{part}", [whole])],
                    "kinds": pa.array([kinds], pa.list_(pa.int64())),
                }
            )

        bodies = counted.filter("body IS NOT NULL").select("part", "body")
        found = bodies.groupBy("part").applyInArrow(write_next, "part int, path string, kinds array<long>")
        told = stage(found, "lm-next").toArrow().to_pylist()
        next_files: list = [None] * parts
        for row in told:
            next_files[row["part"]] = row["path"]
        sums = np.sum([row["kinds"] for row in told], axis=0)
        return LmModel(
            train_tokens, vocabulary, token_files, bases, pair_files, next_files, spread, hot_stats,
            pair_discounts, _discounts(sums[:4]), int(sums[5]), np.array([sums[0], sums[1], sums[4]], float), params,
        )


def score_texts(docs: DataFrame, model: LmModel) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    A text's tokens are its words and one end, so a null or empty text has one token. `docs` needs `doc_id`
    and `text`; other columns are ignored. Repeated rows give repeated results and count as often when the
    model learns. A null `doc_id` stays null and is learned from. Without any training row, every token has
    the same probability.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
        for batch in batches:
            for part in chunks(batch, "text"):
                n, known, base, logs = model.score(part.column("text"))
                columns = [n, known, np.full(len(n), model.train_tokens), base, logs, 10 ** np.minimum(-logs / n, 300)]
                kinds = [pa.int64()] * 3 + [pa.float64()] * 3
                arrays = [pa.array(x.astype(k.to_pandas_dtype()), k) for x, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("held_out"), *arrays], names)

    rows = docs.select("doc_id", held_out(F.col("doc_id"), model.params).alias("held_out"), "text")
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, perplexity double"
    )
    return rows.mapInArrow(score, schema)
