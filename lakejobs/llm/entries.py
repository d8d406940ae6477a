"""The operators as registered queries: each runs over its whole table and returns its digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.llm.decontamination import find_passages
from lakejobs.llm.embedding_dedup import near_vectors
from lakejobs.llm.hard_negatives import mine_hard_negatives
from lakejobs.llm.html_extraction import extract_text
from lakejobs.llm.importance_resampling import resample
from lakejobs.llm.license_scan import scan_licenses
from lakejobs.llm.line_dedup import line_decisions
from lakejobs.llm.minhash_dedup import MinMaxParams, near_duplicates
from lakejobs.llm.ngram_lm import score_texts, train_lm
from lakejobs.llm.packing import pack
from lakejobs.llm.quality_classifier import score_quality, train_quality
from lakejobs.llm.secret_scan import scan_secrets
from lakejobs.llm.shared import table
from lakejobs.llm.token_counts import count_tokens

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("secrets")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, train_lm(docs)).drop("perplexity")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("hits", "items")


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), MinMaxParams(width=4))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_decisions(table(spark, sf_dir, "documents"))
    dropped = F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped")
    return found.select("doc_id", "n_lines", "n_long", "n_dropped", dropped)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


# Both engines split by the same expression; DuckDB's `\\x00` needs no class of its own as texts hold none.
_WORDS = r"""list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

# Smallest id that each id reaches over `links` (a, b), both ways.
_REACHED = """both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)"""

ORACLES: dict[str, str] = {
    "op5_embedding_dedup": f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id
          WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
{_REACHED},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       least(vec_id, coalesce(low, vec_id)) = vec_id AS kept
FROM v LEFT JOIN counts ON counts.a = vec_id LEFT JOIN lowest ON lowest.a = vec_id""",
    "op9_minhash_dedup": rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, w[i:i + 3] AS s
             FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM d)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y USING (s)
           WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE 100 * c >= 80 * (p.n + q.n - c)),
{_REACHED}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(low, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.a = d.doc_id""",
    "op8_decontamination": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS n
      FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0 AND item_id IS NOT NULL),
grams AS (SELECT DISTINCT item, n, w[i:i + n - 1] AS gram
          FROM (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
places AS (SELECT r, n, i, w[i:i + n - 1] AS gram FROM (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM d, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
hits AS (SELECT r, n, i, item FROM places JOIN grams USING (n, gram)),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
          FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op11_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL),
scores AS (SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same,
                  CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
           FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor, other, score FROM scores WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) <= 5""",
    # The checksum of a word, byte by byte, with the table that its polynomial gives.
    "op12_importance_resampling": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
found AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM d) GROUP BY ALL),
wanted AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM b) GROUP BY ALL),
codes AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS code),
digits AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM found UNION SELECT word FROM wanted)),
bytes AS (SELECT word, list_transform(range(0, len(h) // 2), lambda i:
    16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1) AS b FROM digits),
buckets AS (SELECT word, xor(4294967295, list_reduce(list_concat([4294967295], CAST(b AS BIGINT[])),
    lambda c, x: xor(code[xor(c % 256, x) + 1], c // 256))) % 10000 AS bucket FROM bytes, codes),
s AS (SELECT bucket, sum(n) AS n FROM found JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM wanted JOIN buckets USING (word) GROUP BY bucket),
gains AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
    / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS gain FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT r, CAST(sum(n * gain) AS BIGINT) AS weight FROM found JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE)
        / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN weights USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100 THEN place END AS rank
FROM ranked""",
}
QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        op1_html_extraction,
        op2_secret_scan,
        op3_license_scan,
        op4_quality_classifier,
        op5_embedding_dedup,
        op6_lm_scoring,
        op7_packing,
        op8_decontamination,
        op9_minhash_dedup,
        op10_line_dedup,
        op11_hard_negatives,
        op12_importance_resampling,
        op13_token_counts,
    )
}
