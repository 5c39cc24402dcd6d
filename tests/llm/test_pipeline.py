"""The pipeline and the registered queries on the smallest tables."""

import hashlib

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from answerloom.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents after every stage, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SMALL).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(stages[-1].columns)
    assert stages[-1].count() == stages[-2].count()


def test_decisions_take_effect(spark, stages):
    raw, good, single, redacted, mixed, encoded = stages
    assert raw.count() > good.count() > single.count()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert good.join(labels, "doc_id").where("quality = 0").count() <= 1
    assert good.join(labels, "doc_id").where("quality = 1").count() >= 0.98 * raw.join(labels, "doc_id").where(
        "quality = 1").count()
    assert single.select("doc_id").distinct().count() == single.count() == redacted.count()
    assert redacted.where(r"text rlike '[A-Za-z0-9]@[A-Za-z0-9-]+\\.[a-z]'").count() == 0
    assert redacted.where("n_chars <> length(text)").count() == 0
    assert 1 < max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 3
    texts = {hashlib.sha256(r["text"].encode()).hexdigest() for r in mixed.select("text").collect()}
    assert {r["decoded_sha256"] for r in encoded.select("decoded_sha256").collect()} == texts


def test_run_gives_the_rows_of_the_stages(spark, stages):
    names = ["doc_id", "n_tokens", "ids_sha256"]
    want = sorted(tuple(r) for r in stages[-1].select(*names).collect())
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).select(*names).collect()) == want


def test_odd_documents_pass_all_stages(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, kept boolean"
    rows = [(1, None, None, None, None, 1, True), (None, "some text of no id", None, "s", 18, 1, True),
            (2, "", "en", "s", 0, 1, False), (3, "w " * 60000, "en", "t", 120000, 1, False), (3, "w " * 60000, "en", "t", 120000, 1, False)]
    for count in (len(rows), 0):
        docs = spark.createDataFrame(rows, schema).limit(count)
        for no, (_, stage) in enumerate(corpus_pipeline.STAGES):
            result = stage(spark, docs, SMALL)
            if no < 4:
                assert result.columns == docs.columns
                docs = spark.createDataFrame(result.collect(), result.schema)
            else:
                assert result.count() == docs.count()


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = sorted(result.fetchall())
    frame = QUERIES[name](spark, SMALL)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(tuple(r) for r in frame.select(*names).collect()) == want
