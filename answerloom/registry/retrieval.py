"""Vectors, exact and approximate search, BM25, fusion.

Scores come out as they were ranked, rounded once to SCORE_DIGITS: rounding a second
time would turn exact halves into differences between engines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from answerloom.functions import vectors as V
from answerloom.operators import (
    ann, coded, contrastive, embedding, graph, metrics, postings, retrieval, scoring, sparse, streamed)
from answerloom.operators.stored import shared_folder, written_once
from answerloom.plans.corpus import passage_input, passage_words
from answerloom.plans.retrieve import dense_retrieval, retrieved_passages as _retrieved
from answerloom.registry.base import (
    benchmark_questions, passage_table, passages, query, table, vector_pairs, vector_questions, vectors)
from answerloom.registry.sql import DENSE, RETRIEVED, SPARSE, VECTORS, with_


@query(with_(VECTORS, "SELECT passage_id AS pair_id, score FROM scored "
                      "WHERE question_id = passage_id"))
def inner_product(spark, sf_dir):
    product = V.inner_product(F.col("question_vector"), F.col("passage_vector"))
    return vector_pairs(spark, sf_dir).select("pair_id", F.round(product, scoring.SCORE_DIGITS).alias("score"))


def _micro(vector):
    """Vector as whole millionths in one string, the same text on every engine."""
    return F.array_join(F.transform(vector, lambda x: F.round(x * 1000000).cast("bigint")
                                    .cast("string")), " ")


@query(with_(VECTORS, "SELECT question_id AS pair_id, array_to_string(list_transform(v, lambda x: "
                      "CAST(round(x / sqrt(list_dot_product(v, v)) * 1000000) AS BIGINT)), ' ') "
                      "AS unit FROM qv"))
def l2_normalize(spark, sf_dir):
    return vector_pairs(spark, sf_dir).select(
        "pair_id", _micro(V.l2_normalize(F.col("question_vector"))).alias("unit"))


_DENSE_MAPS = {
    "pm": "SELECT passage_id, list(slot) AS s, list(x) AS x FROM pvec GROUP BY passage_id",
    "qm": "SELECT question_id, list(slot) AS s, list(x) AS x FROM qvec GROUP BY question_id",
}


def _dense_text(name, ids):
    return (f"SELECT {ids}, array_to_string(list_transform(range(256), lambda k: CAST(round(coalesce("
            f"x[list_position(s, k)], 0.0) * 1000000) AS BIGINT)), ' ') AS vector FROM {name}")


@query(with_({**DENSE, **_DENSE_MAPS}, _dense_text("pm", "passage_id")))
def embed_passages(spark, sf_dir):
    rows = embedding.hashed_vectors(passage_input(passages(spark, sf_dir)), "passage_id", "text")
    return rows.select("passage_id", _micro(F.col("vector").cast("array<double>")).alias("vector"))


@query(with_({**DENSE, **_DENSE_MAPS}, _dense_text("qm", "question_id")))
def embed_questions(spark, sf_dir):
    rows = embedding.hashed_vectors(benchmark_questions(spark, sf_dir), "question_id", "text")
    return rows.select("question_id", _micro(F.col("vector").cast("array<double>")).alias("vector"))


_TOP = ("QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY score DESC, passage_id) "
        "<= 20")
_TOPK_SQL = with_({**VECTORS, "top": f"SELECT * FROM scored {_TOP}"},
                  "SELECT question_id, CAST(row_number() OVER (PARTITION BY question_id ORDER BY "
                  "score DESC, passage_id) AS INT) AS rank, passage_id, score "
                  "FROM top")


@query(_TOPK_SQL)
def topk_retrieval(spark, sf_dir):
    return scoring.top_passages(vector_questions(spark, sf_dir), vectors(spark, sf_dir), 20)


@query(_TOPK_SQL)
def topk_retrieval_blocks(spark, sf_dir):
    """The layout for question sets too large to broadcast."""
    return scoring.top_passages(vector_questions(spark, sf_dir), vectors(spark, sf_dir), 20,
                                broadcast_questions=0, question_block=300, passage_block=400)


@query(_TOPK_SQL)
def topk_streamed(spark, sf_dir):
    """Stored blocks of questions, one after the other, against passages that stay where they are."""
    return streamed.top_streamed(written_once(vector_questions(spark, sf_dir)), vectors(spark, sf_dir), 20)


def _ranks(spark, sf_dir):
    return contrastive.gold_ranks(vector_pairs(spark, sf_dir), vectors(spark, sf_dir))


@query(with_(VECTORS, "SELECT question_id, gold_score, gold_rank "
                      "FROM ranks"))
def gold_rank(spark, sf_dir):
    return _ranks(spark, sf_dir)


@query(with_(VECTORS, "SELECT k, round(100 * avg(CAST(gold_rank <= k AS INT)), 6) AS precision "
                      "FROM ranks, (VALUES (1), (5), (10)) t(k) GROUP BY k"))
def precision_at_k(spark, sf_dir):
    return contrastive.precision_at(_ranks(spark, sf_dir), (1, 5, 10)).withColumn(
        "precision", F.round("precision", 6))


@query(with_(VECTORS, "SELECT count(*) AS n_questions, " + ", ".join(
    f"round(avg(CAST(gold_rank <= {k} AS INT)), 6) AS top_{k}" for k in (5, 20, 50))
    + " FROM ranks"))
def topk_accuracy(spark, sf_dir):
    return metrics.top_k_accuracy(_ranks(spark, sf_dir)).withColumns(
        {f"top_{k}": F.round(f"top_{k}", 6) for k in (5, 20, 50)})


@query(with_(RETRIEVED, "SELECT question_id, CAST(rank AS INT) AS rank, passage_id, title, text, "
                        "score FROM retrieved"))
def retrieved_passages(spark, sf_dir):
    return _retrieved(benchmark_questions(spark, sf_dir), passage_table(spark, sf_dir), 5)


@query(with_(RETRIEVED, "SELECT question_id, CAST(rank AS INT) AS rank, passage_id, title || "
                        "' 글: ' || r.text || '질문: ' || q.text AS prompt FROM retrieved r "
                        "JOIN questions q USING (question_id)"))
def context_prompts(spark, sf_dir):
    asked = benchmark_questions(spark, sf_dir)
    return retrieval.context_prompts(_retrieved(asked, passage_table(spark, sf_dir), 5), asked)


@query(with_(RETRIEVED, "SELECT question_id, string_agg(text, chr(31) ORDER BY rank) AS texts, "
                        "string_agg(CAST(CAST(round(score * 1000000) AS BIGINT) AS VARCHAR), ' ' "
                        "ORDER BY rank) AS scores FROM retrieved GROUP BY question_id"))
def retrieval_export(spark, sf_dir):
    lists = retrieval.export_lists(
        _retrieved(benchmark_questions(spark, sf_dir), passage_table(spark, sf_dir), 5))
    return lists.select("question_id", F.array_join("texts", "\x1f").alias("texts"),
                        _micro(F.col("scores")).alias("scores"))


@query(with_(SPARSE, "SELECT question_id, CAST(rank AS INT) AS rank, passage_id, score "
                     "FROM sparse_ranked WHERE rank <= 20"))
def bm25_topk(spark, sf_dir):
    return sparse.bm25_top(benchmark_questions(spark, sf_dir), passage_table(spark, sf_dir), 20)


def _scaled(name, source):
    return {name: f"SELECT question_id, passage_id, rank, CASE WHEN max(score) OVER w > min(score) "
                  f"OVER w THEN (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER "
                  f"w) ELSE 1.0 END AS x FROM {source} WHERE rank <= 50 "
                  f"WINDOW w AS (PARTITION BY question_id)"}


_BOTH = {**DENSE, **{k: v for k, v in SPARSE.items() if k not in DENSE},
         **_scaled("d", "dense_ranked"), **_scaled("s", "sparse_ranked")}


def _fused(score):
    return with_({**_BOTH, "fused": f"SELECT question_id, passage_id, round({score}, 9) AS score "
                                    "FROM d FULL JOIN s USING (question_id, passage_id)"},
                 "SELECT question_id, CAST(row_number() OVER (PARTITION BY question_id ORDER BY "
                 "fused.score DESC, passage_id) AS INT) AS rank, passage_id, "
                 "fused.score AS score FROM fused QUALIFY row_number() OVER (PARTITION "
                 "BY question_id ORDER BY fused.score DESC, passage_id) <= 20")


def _both_lists(spark, sf_dir):
    asked, stored = benchmark_questions(spark, sf_dir), written_once(passage_words(passages(spark, sf_dir)))
    return dense_retrieval(asked, stored, 50), sparse.bm25_top(asked, stored, 50)


@query(_fused("0.5 * coalesce(d.x, 0.0) + 0.5 * coalesce(s.x, 0.0)"))
def hybrid_rerank(spark, sf_dir):
    return sparse.fuse(*_both_lists(spark, sf_dir), 20)


@query(_fused("coalesce(1 / (60 + d.rank), 0.0) + coalesce(1 / (60 + s.rank), 0.0)"))
def hybrid_rank_fusion(spark, sf_dir):
    return sparse.fuse_ranks(*_both_lists(spark, sf_dir), 20)


# Cells fixed by rule: a fiftieth of the vectors, at most 65,536, those with the smallest md5 of the id, are centres.
_CELLS = {
    **VECTORS,
    "centres": "SELECT v AS c, row_number() OVER (ORDER BY md5(CAST(passage_id AS VARCHAR)), passage_id) - 1 AS cell FROM "
               "vec QUALIFY cell < least(65536, greatest(1, (SELECT count(*) FROM vec) // 50))",
    "placed": "SELECT passage_id, v, CAST(arg_min(cell, (round(list_dot_product(c, c) - 2 * list_dot_product(v, c), "
              "9), cell)) AS INT) AS cell FROM vec CROSS JOIN centres GROUP BY passage_id, v",
    "probes": "SELECT question_id, cell FROM qv CROSS JOIN centres QUALIFY row_number() OVER (PARTITION BY question_id "
              "ORDER BY round(list_dot_product(c, c) - 2 * list_dot_product(v, c), 9), cell) <= 2",
    "probed": "SELECT s.* FROM scored s JOIN placed p USING (passage_id) JOIN probes r ON r.question_id = "
              "s.question_id AND r.cell = p.cell",
}
_PROBED_SQL = ("SELECT question_id, CAST(row_number() OVER w AS INT) AS rank, passage_id, score FROM probed WINDOW w "
               "AS (PARTITION BY question_id ORDER BY score DESC, passage_id) QUALIFY row_number() OVER w <= 20")


def _fixed_cells(spark, sf_dir):
    """Centres, at most MOST_CELLS of them at every size, and the index in a table stored by cell."""
    stored = vectors(spark, sf_dir)
    n_cells = min(ann.MOST_CELLS, max(1, stored.count() // 50))
    chosen = stored.orderBy(F.md5(F.col("passage_id").cast("string")), "passage_id").limit(n_cells).toArrow()
    centres = scoring._matrix(chosen["vector"])
    path = f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    ann.write_index(ann.build_index(stored, centres), path)
    return centres, ann.read_index(spark, path)


@query(with_(_CELLS, "SELECT passage_id, cell FROM placed"))
def ann_fixed_cells(spark, sf_dir):
    """Cell of every passage, read back from the stored index."""
    return _fixed_cells(spark, sf_dir)[1].select("passage_id", "cell")


@query(with_(_CELLS, _PROBED_SQL))
def ann_fixed_search(spark, sf_dir):
    """The two nearest cells of a stored index, probed."""
    centres, index = _fixed_cells(spark, sf_dir)
    return ann.search(vector_questions(spark, sf_dir), index, centres, 20, 2)


@query(with_(_CELLS, _PROBED_SQL))
def rescored_passages(spark, sf_dir):
    """Returned ids, scored anew from the vectors."""
    found = ann_fixed_search(spark, sf_dir).select("question_id", "passage_id")
    return retrieval.rescore(found, vector_questions(spark, sf_dir), vectors(spark, sf_dir), 20)


@query(with_({**SPARSE, "stored": "SELECT * FROM sparse_ranked WHERE rank <= 50",
              **{k: v for k, v in DENSE.items() if k not in SPARSE},
              "fused": "SELECT question_id, passage_id, round(coalesce(1 / (60 + d.rank), 0.0) + coalesce(1 / (60 + "
                       "s.rank), 0.0), 9) AS score FROM (SELECT * FROM dense_ranked WHERE rank <= 50) d FULL JOIN "
                       "stored s USING (question_id, passage_id)"},
             "SELECT question_id, CAST(row_number() OVER w AS INT) AS rank, passage_id, score FROM fused WINDOW w AS "
             "(PARTITION BY question_id ORDER BY score DESC, passage_id) QUALIFY row_number() OVER w <= 20"))
def sparse_table_rerank(spark, sf_dir):
    """Sparse results come from a stored table of id and score lists, then meet the dense ones."""
    dense, ranked = _both_lists(spark, sf_dir)
    lists = ranked.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("rank", "passage_id", "score"))).alias("h"))
    table_ = written_once(lists.select("question_id", F.col("h.passage_id").alias("ids"), F.col("h.score").alias("scores")))
    return sparse.fuse_ranks(dense, sparse.unpack_sparse(table_), 20)


@query()
def ann_index(spark, sf_dir):
    stored = vectors(spark, sf_dir)
    return ann.build_index(stored, ann.train_cells(stored)).select("passage_id", "cell")


def _search(spark, sf_dir, every_cell=False):
    stored, asked = vectors(spark, sf_dir), vector_questions(spark, sf_dir)
    cells = ann.train_cells(stored)
    index = written_once(ann.by_cell(ann.build_index(stored, cells)))
    n_probe = len(cells) if every_cell else ann.fitted_probes(asked, stored, index, cells, 20)
    return ann.search(asked, index, cells, 20, n_probe)


@query()
def ann_retrieval(spark, sf_dir):
    """As many cells probed as a sample of questions needs for a recall of 0.9."""
    return _search(spark, sf_dir)


@query(_TOPK_SQL)
def ann_all_cells(spark, sf_dir):
    """With every cell probed the index gives the exact answer."""
    return _search(spark, sf_dir, every_cell=True)


@query()
def ann_recall(spark, sf_dir):
    exact = scoring.top_passages(vector_questions(spark, sf_dir), vectors(spark, sf_dir), 20)
    return ann.recall(_search(spark, sf_dir), exact)


# Shards of the graph are dealt by md5, so a small table states them: 8 at most, of 256 rows at least.
_GRAPH_SQL = """
WITH n AS (SELECT greatest(1, (count(*) + 8191) // 8192, least(8, count(*) // 256)) AS shards FROM embeddings),
dealt AS (SELECT CAST(CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) % shards AS INT) AS shard
          FROM embeddings, n)
SELECT shard, count(*) AS n_rows, CAST(count(*) * least(count(*) - 1, 24) AS BIGINT) AS n_links, CAST(0 AS BIGINT) AS n_loops,
       CAST(0 AS BIGINT) AS n_repeated, CAST(0 AS BIGINT) AS n_outside, CAST(0 AS BIGINT) AS n_one_way
FROM dealt GROUP BY shard
"""


def _graph(spark, sf_dir):
    path = f"{shared_folder(spark)}/graph-{uuid.uuid4().hex}"
    graph.write_graph(graph.build_graph(vectors(spark, sf_dir)), path)
    return graph.read_graph(spark, path)


@query(_GRAPH_SQL)
def graph_index(spark, sf_dir):
    """The stored graph, audited: every passage has its links, and none breaks a rule."""
    return graph.graph_audit(_graph(spark, sf_dir))


def _graph_search(spark, sf_dir):
    asked, stored = written_once(vector_questions(spark, sf_dir)), vectors(spark, sf_dir)
    index = _graph(spark, sf_dir)
    return graph.search_graph(asked, index, 20, graph.fitted_beam(asked, stored, index, 20))


@query()
def graph_search(spark, sf_dir):
    """Walks with a beam as wide as a sample of questions needs for a recall of 0.9."""
    return _graph_search(spark, sf_dir)


@query()
def graph_recall(spark, sf_dir):
    exact = scoring.top_passages(vector_questions(spark, sf_dir), vectors(spark, sf_dir), 20)
    return ann.recall(_graph_search(spark, sf_dir), exact)


@query(with_(SPARSE, "SELECT question_id, CAST(rank AS INT) AS rank, passage_id, score FROM sparse_ranked WHERE rank <= 20"))
def bm25_index_topk(spark, sf_dir):
    """BM25 from a stored index that was written in two steps."""
    path = f"{shared_folder(spark)}/postings-{uuid.uuid4().hex}"
    stored = passage_table(spark, sf_dir)
    postings.write_postings(stored.where(F.col("passage_id") % 3 != 0), path)
    postings.append_postings(stored.where(F.col("passage_id") % 3 == 0), path)
    return postings.search_postings(benchmark_questions(spark, sf_dir), spark, path, 20)


# Codebooks by rule: the 256 vectors with the smallest md5 of the id, cut into parts of four components.
_CODED = {
    **VECTORS,
    "books": "SELECT v AS c, row_number() OVER (ORDER BY md5(CAST(passage_id AS VARCHAR)), passage_id) - 1 AS code FROM vec "
             "QUALIFY code < 256",
    "part_no": "SELECT unnest(range((SELECT (max(len(v)) + 3) // 4 FROM vec))) AS m",
    "book_parts": "SELECT m, code, c[4 * m + 1:4 * m + 4] AS c FROM books, part_no",
    "nearest": "SELECT passage_id, m, arg_min(code, (round(list_dot_product(c, c) - 2 * list_dot_product(v[4 * m + 1:4 * m + 4], "
               "c), 9), code)) AS code FROM vec JOIN book_parts ON true GROUP BY passage_id, m",
}
_CODED_SEARCH = {
    **_CODED,
    "known": "SELECT passage_id, flatten(list(c ORDER BY m)) AS c FROM nearest JOIN book_parts USING (m, code) GROUP BY passage_id",
    "candidates": "SELECT question_id, passage_id FROM qv CROSS JOIN known QUALIFY row_number() OVER (PARTITION BY question_id "
                  "ORDER BY round(list_dot_product(qv.v, known.c), 9) DESC, passage_id) <= 100",
}


def _codes(spark, sf_dir, rounds):
    stored = vectors(spark, sf_dir)
    books = coded.refined_books(stored, coded.rule_books(stored), rounds)
    return books, written_once(coded.coded(stored, books))


@query(with_(_CODED, "SELECT passage_id, string_agg(CAST(code AS VARCHAR), ' ' ORDER BY m) AS codes FROM nearest GROUP BY passage_id"))
def coded_index(spark, sf_dir):
    """The stored bytes of every passage, as numbers of centres."""
    codes = _codes(spark, sf_dir, 0)[1]
    return codes.select("passage_id", F.array_join(F.transform(
        "codes", lambda c: (c.cast("int") + 128).cast("string")), " ").alias("codes"))


@query(with_(_CODED_SEARCH, "SELECT question_id, CAST(row_number() OVER w AS INT) AS rank, passage_id, score FROM candidates JOIN "
                            "scored USING (question_id, passage_id) WINDOW w AS (PARTITION BY question_id ORDER BY score DESC, "
                            "passage_id) QUALIFY row_number() OVER w <= 20"))
def coded_fixed_search(spark, sf_dir):
    """The 100 best by codes of codebooks by rule, scored anew."""
    books, codes = _codes(spark, sf_dir, 0)
    return coded.coded_search(written_once(vector_questions(spark, sf_dir)), vectors(spark, sf_dir), codes, books, 20, 100)


def _coded_search(spark, sf_dir):
    asked, stored = written_once(vector_questions(spark, sf_dir)), vectors(spark, sf_dir)
    books, codes = _codes(spark, sf_dir, coded.ROUNDS)
    n = coded.fitted_candidates(asked, stored, codes, books, 20)
    return coded.coded_search(asked, stored, codes, books, 20, n)


@query()
def coded_search(spark, sf_dir):
    """As many candidates by refined codes as a sample of questions needs for a recall of 0.9."""
    return _coded_search(spark, sf_dir)


@query()
def coded_recall(spark, sf_dir):
    exact = scoring.top_passages(vector_questions(spark, sf_dir), vectors(spark, sf_dir), 20)
    return ann.recall(_coded_search(spark, sf_dir), exact)
