"""Queries that go through files: dumps, tables by split, pluggable encoders, miss reports."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from answerloom.functions.ids import in_test_split
from answerloom.functions.text import clean_newlines, strip
from answerloom.operators import embedding, qa
from answerloom.operators.skew import use_all_cores
from answerloom.operators.stored import shared_folder
from answerloom.registry.base import articles, qa_rows, query, table
from answerloom.registry.sql import ARTICLES, QA, clean, in_test, with_
from answerloom.sources import pieces, tables


OBJECT_BYTES, OBJECT_ROWS = 64 << 20, 100_000


def _path(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"SELECT doc_id, source, n_chars FROM documents WHERE {in_test(0.1, 5, 'doc_id')}")
def split_roundtrip(spark, sf_dir):
    """Documents stored by split; the test split is read back alone, with its schema checked."""
    path = _path(spark, "splits")
    rows = tables.with_split(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"),
                             in_test_split(0.1, 5, F.col("doc_id")))
    tables.write_splits({name: rows.where(F.col("split") == name).drop("split") for name in ("train", "test")}, path)
    copy = _path(spark, "table")
    tables.write_table(tables.read_split(spark, path, "test"), copy)
    return tables.read_table(spark, copy, table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").schema)


_DUMP_SQL = "SELECT CAST(doc_id AS VARCHAR) AS row_key, doc_id AS article_id, lang AS title, text FROM documents"


def _dumped(spark, sf_dir):
    """Path of dump files, each of JSON objects of many articles, written from the documents."""
    path = _path(spark, "dump")
    docs = table(spark, sf_dir, "documents")
    # Objects of about 64 MB of text or 100,000 articles, however large the table is; a key occurs once in an object.
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    groups = max(4, -(-(size["bytes"] or 0) // OBJECT_BYTES), -(-size["n"] // OBJECT_ROWS))
    rows = docs.select(
        F.col("doc_id").cast("string").alias("key"),
        F.struct("text", F.col("lang").alias("title"), F.col("doc_id").alias("document_id"), "source").alias("a"))
    objects = rows.groupBy(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("file")).agg(
        F.map_from_entries(F.collect_list(F.struct("key", "a"))).alias("m"))
    objects.select(F.to_json("m").alias("value")).write.text(path)
    return path


@query(_DUMP_SQL)
def read_dump_files(spark, sf_dir):
    """Dump files read object by object."""
    return tables.parse_dump(spark.read.text(_dumped(spark, sf_dir)))


@query(_DUMP_SQL)
def read_dump_splits(spark, sf_dir):
    """The same files read by byte ranges."""
    return pieces.read_dump_splits(spark, _dumped(spark, sf_dir))


@query("SELECT doc_id AS article_id, lang AS title, text FROM documents")
def read_article_lines(spark, sf_dir):
    path = _path(spark, "lines")
    tables.write_article_lines(articles(spark, sf_dir), path)
    return tables.read_article_lines(spark, path)


def _letter_counts(texts):
    """A batch encoder: how often each vowel occurs, and the length."""
    return np.array([[*(t.count(v) for v in "aeiou"), len(t)] for t in map(str, texts)], np.float32).reshape(-1, 6)


@query("SELECT doc_id, " + " || ' ' || ".join(
    f"CAST(len(text) - len(replace(text, '{v}', '')) AS VARCHAR)" for v in "aeiou")
    + " || ' ' || len(text) AS counts FROM documents")
def embed_custom(spark, sf_dir):
    """Vectors of an encoder given as a function."""
    rows = use_all_cores(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    vectors = embedding.embed(rows, "doc_id", "text", _letter_counts)
    return vectors.select("doc_id", F.array_join(F.transform(
        "vector", lambda x: x.cast("bigint").cast("string")), " ").alias("counts"))


_ALTERED = {**QA, "altered": "SELECT qa_id, title, CASE WHEN qa_id % 3 = 0 THEN context || ' x' ELSE context END AS "
                             "context FROM qa",
            "known": "SELECT title, text, min(article_id) AS article_id FROM articles GROUP BY title, text"}


@query(with_(_ALTERED, "SELECT qa_id, title FROM altered a WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.title = "
                       "a.title AND k.text = a.context)"))
def repair_misses(spark, sf_dir):
    """Questions whose context is in no article: every third one was changed."""
    altered = qa_rows(spark, sf_dir).drop("article_id").withColumn("context", F.when(
        F.col("qa_id") % 3 == 0, F.concat("context", F.lit(" x"))).otherwise(F.col("context")))
    return qa.missed(qa.repair_article_ids(altered, articles(spark, sf_dir))).select("qa_id", "title")


@query(with_({**ARTICLES}, f"SELECT article_id, trim({clean('text')}, chr(32) || chr(10) || chr(9)) AS text FROM articles"))
def stripped_texts(spark, sf_dir):
    """Cleaned texts without white space at their ends."""
    return articles(spark, sf_dir).select("article_id", strip(clean_newlines(F.col("text"))).alias("text"))
