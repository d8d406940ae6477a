"""Find secrets by rules, with a trigram index that says which texts a rule has to be run on.

From each rule's expression a Boolean query of trigrams is derived that every matching text fulfils.
Each Arrow batch gets an inverted index of the trigrams in those queries, made from the texts' bytes;
postings are intersected and united, and the expression is run on the texts left. A rule without
mandatory trigrams, such as a run of hexadecimal digits, is run on every text. Index and texts live in
the same task, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakejobs.llm.shared import chunks, text_bytes

# A part of an expression that stands for more texts than this is left out of the query.
MOST_ALTERNATIVES = 64
# Of the expressions' letters, case does not matter to the index.
_FOLD = np.arange(256)
_FOLD[65:91] += 32


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what `pattern` matches, if the group `part` has at least `least` characters."""

    kind: str
    pattern: str
    least: int = 1
    part: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The three base kinds.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
# Further kinds with public, documented forms.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("login", r"://[^\s:/@]+:[^\s:/@]{3,}@[A-Za-z0-9.-]+"),
)

# A query is True (any text), ("tri", text), ("and", queries) or ("or", queries).
Query = bool | tuple


def _join(kind: str, parts: list[Query]) -> Query:
    if kind == "and":
        parts = [x for x in parts if x is not True]
    elif any(x is True for x in parts):
        return True
    parts = list(dict.fromkeys(parts))
    return True if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _texts_query(texts: set[str]) -> Query:
    """Some of `texts` occurs."""
    return _join("or", [_join("and", [("tri", x[i : i + 3]) for i in range(len(x) - 2)]) for x in sorted(texts)])


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """Exactly which texts a sequence matches (None: too many), and what every text that holds a match fulfils."""
    run: set[str] | None = {""}
    queries: list[Query] = []

    def end_run() -> None:
        if run:
            queries.append(_texts_query(run))

    for op, value in nodes:
        exact, query = _step(op, value)
        if exact is not None and run is not None and len(run) * len(exact) <= MOST_ALTERNATIVES:
            run = {a + b for a, b in product(run, exact)}
            continue
        end_run()
        queries.append(query)
        run = exact
    whole = run if not queries else None
    end_run()
    return whole, _join("and", queries)


def _step(op, value) -> tuple[set[str] | None, Query]:
    if op is sre.LITERAL:
        return {chr(value).lower()}, True
    if op is sre.IN and all(kind is sre.LITERAL for kind, _ in value) and len(value) <= MOST_ALTERNATIVES:
        return {chr(code).lower() for _, code in value}, True
    if op is sre.SUBPATTERN:
        return _walk(value[3])
    if op is sre.BRANCH:
        branches = [_walk(x) for x in value[1]]
        texts = reduce(lambda a, b: None if a is None or b is None else a | b, [x for x, _ in branches])
        exact = texts if texts is not None and len(texts) <= MOST_ALTERNATIVES else None
        return exact, _join("or", [q if x is None else _texts_query(x) for x, q in branches])
    if op is sre.MAX_REPEAT:
        least, most, inner = value
        exact, query = _walk(inner)
        if least == 0:
            return (exact | {""} if most == 1 and exact is not None else None), True
        return (exact if most == 1 else None), query if exact is None else _texts_query(exact)
    if op is sre.AT:
        return {""}, True
    return None, True


def trigram_query(rule: Rule) -> Query:
    """What the lower-cased text must hold for the rule to match; True if nothing can be said."""
    exact, query = _walk(_parser.parse(rule.pattern, re.ASCII))
    return query if exact is None else _texts_query(exact)


def _trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(_trigrams, query[1]))


class TrigramIndex:
    """Rows in which each of the given trigrams occurs."""

    def __init__(self, grams: list[str], texts: pa.Array):
        data, offsets = text_bytes(texts)
        letters = sorted({byte for gram in grams for byte in gram.encode()})
        size = len(letters) + 1
        code = np.zeros(256, np.int32)
        code[letters] = np.arange(1, size)
        code = code[_FOLD]
        wanted = np.full(size**3, -1, np.int32)
        for i, gram in enumerate(grams):
            a, b, c = (int(code[byte]) for byte in gram.encode())
            wanted[(a * size + b) * size + c] = i
        self.rows = {gram: np.zeros(0, np.int64) for gram in grams}
        if len(data) < 3:
            return
        coded = code[data]
        found = wanted[(coded[:-2] * size + coded[1:-1]) * size + coded[2:]]
        places = np.flatnonzero(found >= 0)
        row = np.searchsorted(offsets, places, "right") - 1
        inside = places + 2 < offsets[row + 1]
        pairs = np.unique(found[places][inside].astype(np.int64) * len(texts) + row[inside])
        for i, gram in enumerate(grams):
            low, high = np.searchsorted(pairs, [i * len(texts), (i + 1) * len(texts)])
            self.rows[gram] = pairs[low:high] - i * len(texts)

    def find(self, query: Query) -> np.ndarray:
        if query[0] == "tri":
            return self.rows[query[1]]
        merge = np.intersect1d if query[0] == "and" else np.union1d
        return reduce(merge, map(self.find, query[1]))


def find_secrets(texts: pa.Array, rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """Of each text, the (start, rule's number, end) of leftmost non-overlapping matches per rule, sorted."""
    queries = [trigram_query(rule) for rule in rules]
    index = TrigramIndex(sorted(set().union(*map(_trigrams, queries))), texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    values = texts.to_pylist()
    for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        pattern, part = rule.compiled(), rule.part
        for row in range(len(texts)) if query is True else index.find(query).tolist():
            for match in pattern.finditer(values[row] or ""):
                if match.end(part) - match.start(part) >= rule.least:
                    found[row].append((match.start(), number, match.end()))
    for row in found:
        row.sort()
    return found


SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "secrets array<struct<kind:string,start:int,end:int>>"
)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """One row per document: its spans, counts of the base kinds, and a digest of the base spans.

    `docs` needs `doc_id` and `text`; other columns are ignored. A null text has no spans, as an empty
    one, and a null `doc_id` stays null. Repeated rows give repeated results. Positions are code points.
    A hexadecimal run is shortened to what can match: a run below the least length is no candidate.
    """
    base = len(BASE_RULES)
    # A run that the least length cuts off never matches later: one class, taken greedily.
    quick = tuple(
        Rule(r.kind, f"{r.pattern[:-1]}{{{r.least},}}") if re.fullmatch(r"\[[^\]]+\]\+", r.pattern) else r
        for r in rules
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = find_secrets(part.column("text"), quick)
                named = [[(rules[k].kind, s, e) for s, k, e in row] for row in found]
                lines = [[f"{kind}:{s}:{e}" for kind, s, e in row] for row in named]
                digests = [
                    hashlib.sha256(
                        ",".join(x for x, (_, k, _) in zip(a, b, strict=True) if k < base).encode()
                    ).hexdigest()
                    for a, b in zip(lines, found, strict=True)
                ]
                counts = [[sum(k == n for _, k, _ in row) for row in found] for n in range(base)]
                secrets = [[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in named]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        *(pa.array(x, pa.int64()) for x in counts),
                        pa.array(digests, pa.string()),
                        pa.array([",".join(x) for x in lines], pa.string()),
                        pa.array(secrets, kind),
                    ],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "secrets"],
                )

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)
