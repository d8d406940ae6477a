"""Tokens of each document, from the lengths of its pre-tokens.

A byte-level tokenizer codes each pre-token by itself, so a text has as many tokens as its pre-tokens have
together. Lengths are looked up in two tiers, in the task that reads the text: a broadcast table of the
pre-tokens that are frequent in a sample, then the worker's own cache, which the library fills when a pre-token
is in neither. Only pre-tokens of the sample are ever shuffled; the table decides how fast, never what is counted.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.llm.shared import chunks

TOKENIZER = "byte_bpe_50k.json"
# Characters that the tokenizer's and this module's expressions put into the same classes; pre-tokens of
# texts with others come from the tokenizer itself.
_OTHERS = regex.compile(r"[^\u0000-\u0557\u2010-\u205e\u3000-\u9fff\uac00-\ud7a3]")
# A place where one pre-token ends and the next begins, whatever stands around.
_BORDER = regex.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z])")


@dataclass(frozen=True)
class TokenCountParams:
    """The broadcast table has at most `table_size` pre-tokens of at most `table_chars` characters.

    They are the most frequent ones of about `sample_rows` documents. A worker's cache is emptied when it has
    `cache_size` pre-tokens; those over `cache_chars` characters are not put into it. Texts are looked at in
    pieces of about `piece_chars` characters.
    """

    table_size: int = 32_768
    table_chars: int = 32
    sample_rows: int = 20_000
    cache_size: int = 200_000
    cache_chars: int = 64
    piece_chars: int = 1 << 20
    limit: int = 1024


class PreTokens:
    """The pre-tokens of a text, and the tokens of one, as the tokenizer of a file has them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        settings = json.loads(self.coder.to_str())
        pre = settings["pre_tokenizer"] or {}
        added = settings["added_tokens"]
        plain = not any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in added)
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or settings["normalizer"] or not plain:
            raise ValueError(f"{path}: pre-tokens can be counted apart only for byte-level tokenizers without normalizer")
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        # The longest added token counts where several begin.
        names = sorted((x["content"] for x in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None

    def parts(self, text: str) -> list[str]:
        """The text between its added tokens, each of which is one token."""
        return self.added.split(text) if self.added else [text]

    def split(self, text: str, piece_chars: int) -> Iterator[list[str]]:
        """The pre-tokens, in lists for pieces of the text that end between two of them."""
        start = 0
        while start < len(text):
            border = _BORDER.search(text, start + piece_chars) if len(text) - start > piece_chars else None
            end = border.start() if border else len(text)
            piece = text[start:end] if start or border else text
            if _OTHERS.search(piece):
                yield [piece[a:b] for _, (a, b) in self.coder.pre_tokenizer.pre_tokenize_str(piece)]
            else:
                yield self.pattern.findall(piece)
            start = end

    def length(self, piece: str) -> int:
        return len(self.coder.encode(piece, add_special_tokens=False).ids)


@lru_cache(maxsize=4)
def _pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


@lru_cache(maxsize=4)
def _worker_cache(path: str) -> dict[str, int]:
    """Lengths found by this worker, kept from task to task."""
    return {}


class Lengths(dict):
    """The table of frequent pre-tokens; what it lacks comes from the worker's cache or is coded."""

    def __init__(self, table: dict[str, int], path: str, params: TokenCountParams):
        super().__init__(table)
        self.cache, self.length, self.params = _worker_cache(path), _pre_tokens(path).length, params

    def __missing__(self, piece: str) -> int:
        found = self.cache.get(piece)
        if found is None:
            found = self.length(piece)
            if len(piece) <= self.params.cache_chars:
                if len(self.cache) >= self.params.cache_size:
                    self.cache.clear()
                self.cache[piece] = found
        return found


def counter(table: dict[str, int], path: str, params: TokenCountParams) -> Callable[[str | None], int]:
    """A function that counts a text's tokens."""
    pre, lengths = _pre_tokens(path), Lengths(table, path, params)
    look_up = lengths.__getitem__

    def count(text: str | None) -> int:
        if not text:
            return 0
        parts = pre.parts(text)
        return len(parts) - 1 + sum(sum(map(look_up, pieces)) for part in parts for pieces in pre.split(part, params.piece_chars))

    return count


def frequent_lengths(docs: DataFrame, path: str, params: TokenCountParams) -> dict[str, int]:
    """The most frequent pre-tokens of a sample, and how many tokens each is; bounded by `table_size`."""
    rows = docs.count()
    if not rows or not params.table_size:
        return {}
    # Different pre-tokens that a task holds at most.
    most = 300_000

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, counts = _pre_tokens(path), Counter()

        def out() -> pa.RecordBatch:
            short = {x: n for x, n in counts.items() if len(x) <= params.table_chars}
            return pa.RecordBatch.from_arrays(
                [pa.array(short.keys(), pa.string()), pa.array(short.values(), pa.int64())], ["piece", "n"]
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                for part in pre.parts(text or ""):
                    for pieces in pre.split(part, params.piece_chars):
                        counts.update(pieces)
                        if len(counts) > most:
                            yield out()
                            counts.clear()
        yield out()

    sampled = docs.select("text").sample(min(1.0, params.sample_rows / rows), seed=13)
    summed = sampled.mapInArrow(occurrences, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    top = summed.orderBy(F.desc("n"), "piece").limit(params.table_size).toArrow()
    length = _pre_tokens(path).length
    return {piece: length(piece) for piece in top.column("piece").to_pylist()}


def count_tokens(docs: DataFrame, tokenizer: str | None = None, params: TokenCountParams | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    `docs` needs `doc_id` and `text`; other columns are ignored. Tokens are those of the tokenizer in the file
    `tokenizer` (the installed byte-level one by default), without added begin or end; where a text holds the
    string of one of its added tokens, that is one token. A null text is empty; empty texts have no bytes and
    no tokens. Repeated rows, and rows with a null `doc_id`, come out each. An empty table gives no rows. Texts of
    any length are counted whole. A tokenizer that does not code pre-tokens one by one is refused (ValueError).
    """
    params = params or TokenCountParams()
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    _pre_tokens(path)
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(table.value, path, params)
        for batch in batches:
            for part in chunks(batch, "text"):
                tokens = pa.array(map(count, part.column("text").to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), tokens], ["doc_id", "n_bytes", "n_tokens"])

    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    counted = docs.select("doc_id", "text", size).mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > params.limit)
