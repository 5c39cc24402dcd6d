"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm import (
    chat, curves, decontamination, kdtree, licences, minhash, mixing, negatives, pieces, pii, quality, toxicity, whitening)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
WEIGHTS = [1, 2, 3]

#: Every source's target, what its rounded target takes of each document, and the slot that takes it first.
_MIX_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
    FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM docs GROUP BY source),
weighed AS (
    SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS no,
           1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS w FROM totals),
filled AS (
    SELECT *, row_number() OVER o AS k, 3 * s AS cap,
           CAST(sum(s) OVER () - coalesce(sum(3 * s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS BIGINT) AS rest,
           CAST(sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS BIGINT) AS weight
    FROM weighed WINDOW o AS (ORDER BY 3.0 * s / w, no)),
level AS (SELECT k, rest, weight FROM filled WHERE rest * w <= cap * weight ORDER BY k LIMIT 1),
shares AS (
    SELECT f.no, f.source, f.s,
           CASE WHEN f.k < l.k THEN CAST(f.cap AS DOUBLE) ELSE CAST(l.rest * f.w AS DOUBLE) / l.weight END AS target
    FROM filled f, level l),
whole AS (
    SELECT sum(target) AS whole,
           greatest(1, least(4096, CAST(round(sum(target)) AS BIGINT) // 65536)) AS block FROM shares),
bounds AS (
    SELECT s.*, w.block, CAST(round(w.whole / w.block) AS BIGINT) AS slots,
           round(4294967296 * (sum(target) OVER (ORDER BY no) - target) / w.whole) AS low,
           round(4294967296 * sum(target) OVER (ORDER BY no) / w.whole) AS high
    FROM shares s, whole w),
points AS (
    SELECT j, (j * 2654435769) % 4294967296 AS point
    FROM (SELECT unnest(range((SELECT max(slots) FROM bounds))) AS j)),
won AS (
    SELECT b.no, p.j, row_number() OVER (PARTITION BY b.no ORDER BY p.j) - 1 AS rank
    FROM bounds b JOIN points p ON p.point >= b.low AND p.point < b.high),
begun AS (
    SELECT d.doc_id, d.size, b.no, b.s, b.target, b.block, b.slots, CAST(floor(b.target + 0.5) AS BIGINT) AS goal,
           sum(d.size) OVER (PARTITION BY b.no ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id) - d.size AS start
    FROM docs d JOIN bounds b ON b.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target,
       CAST(greatest(0, least(start + size, goal) - start)
            + greatest(0, least(s + start + size, goal) - s - start)
            + greatest(0, least(2 * s + start + size, goal) - 2 * s - start) AS BIGINT) AS taken,
       CAST(CASE WHEN size > 0 AND start < goal THEN coalesce(w.j, b.slots + start // block) END AS BIGINT) AS first_slot
FROM begun b LEFT JOIN won w ON w.no = b.no AND w.rank = b.start // b.block
"""

_EXACT_SQL = """
WITH grid AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS g
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.g, c.g), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM grid q JOIN grid c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

#: Similar pairs over an inverted index of shingles, components by repeated minima.
_NEAR_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                                  lambda i: array_to_string(w[i:i + 4], ' '))) AS shingle
    FROM texts WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(doc_id, other) AS (
    SELECT a, b FROM both_ways
    UNION SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON l.a = r.other)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles,
       least(t.doc_id, coalesce(r.low, t.doc_id)) AS component_id,
       t.doc_id = least(t.doc_id, coalesce(r.low, t.doc_id)) AS kept
FROM texts t LEFT JOIN sizes s ON s.doc_id = t.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS low FROM reached GROUP BY doc_id) r ON r.doc_id = t.doc_id
"""

#: Hard negatives by all scores.
_NEGATIVES_SQL = """
WITH grid AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS g
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id, c.label,
           CAST(list_sum(list_transform(list_zip(a.g, c.g), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM grid a JOIN grid c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.own
     AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""

#: Windows of items as texts, looked for at every place of every document.
_LEAKS_SQL = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
items AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
wanted AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
           unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS t
    FROM items WHERE len(w) > 0),
held AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS start,
           unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS t
    FROM docs, (SELECT DISTINCT n FROM wanted) WHERE len(w) >= n),
met AS (SELECT doc_id, start, n, item_id FROM held JOIN wanted USING (n, t)),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(start, start + n)) AS place FROM met) GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY encode(item_id))) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
"""

ORACLES["op2_source_mix"] = _MIX_SQL
ORACLES["op9_exact_top"] = _EXACT_SQL
ORACLES["op10_near_duplicates"] = _NEAR_SQL
ORACLES["op11_hard_negatives"] = _NEGATIVES_SQL
ORACLES["op12_decontamination"] = _LEAKS_SQL


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


@_query
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), WEIGHTS)


@_query
def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.near_top(_table(spark, sf_dir, "embeddings"))


@_query
def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.windows(turns.unionByName(extra)))


@_query
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(_table(spark, sf_dir, "documents"))


@_query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(_table(spark, sf_dir, "documents"), with_ids=False)


@_query
def op9_exact_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.exact_top(_table(spark, sf_dir, "embeddings"))


@_query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved))


@_query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))
