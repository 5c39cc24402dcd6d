"""Answer scoring and metric tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from answerloom.functions import text as X
from answerloom.operators import answers, metrics, retrieval, scoring
from answerloom.operators.skew import use_all_cores
from answerloom.registry.base import (
    dialogues, history, predictions, query, table, vectors)
from answerloom.registry.sql import (
    DIALOGUES, HISTORY, NEIGHBOURS, PREDICTIONS, answer_tokens, normalized, with_)


@query(f"SELECT doc_id, {normalized('text')} AS normalized FROM documents")
def normalize_answer(spark, sf_dir):
    rows = use_all_cores(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", X.normalize_answer(F.col("text")).alias("normalized"))


@query(with_(PREDICTIONS, f"SELECT dialog_id, CAST({normalized('prediction')} = "
                          f"{normalized('gold')} AS INT) AS exact_match FROM predictions"))
def exact_match(spark, sf_dir):
    return answers.exact_match(predictions(spark, sf_dir)).select("dialog_id", "exact_match")


F1 = {
    **PREDICTIONS,
    "golds": "SELECT dialog_id, 0 AS gold_no, prediction, gold FROM predictions UNION ALL "
             "SELECT dialog_id, 1, prediction, question FROM predictions",
    "p": f"SELECT dialog_id, gold_no, t, count(*) AS n FROM (SELECT dialog_id, gold_no, "
         f"unnest({answer_tokens('prediction')}) AS t FROM golds) GROUP BY ALL",
    "g": f"SELECT dialog_id, gold_no, t, count(*) AS n FROM (SELECT dialog_id, gold_no, "
         f"unnest({answer_tokens('gold')}) AS t FROM golds) GROUP BY ALL",
    "same": "SELECT dialog_id, gold_no, sum(least(p.n, g.n)) AS n FROM p "
            "JOIN g USING (dialog_id, gold_no, t) GROUP BY ALL",
    "sizes": f"SELECT dialog_id, gold_no, len({answer_tokens('prediction')}) AS np, "
             f"len({answer_tokens('gold')}) AS ng, CAST({normalized('prediction')} = "
             f"{normalized('gold')} AS INT) AS em FROM golds",
    "f1": "SELECT dialog_id, gold_no, em, np AS n_prediction, ng AS n_gold, "
          "CAST(coalesce(n, 0) AS BIGINT) AS n_same, CASE WHEN coalesce(n, 0) = 0 THEN 0.0 ELSE "
          "2.0 * (n / np) * (n / ng) / ((n / np) + (n / ng)) END AS f1 "
          "FROM sizes LEFT JOIN same USING (dialog_id, gold_no)",
}


@query(with_(F1, "SELECT dialog_id, n_same, n_prediction, n_gold, round(f1, 6) AS f1 FROM f1 "
                 "WHERE gold_no = 0"))
def token_f1(spark, sf_dir):
    return answers.token_f1(predictions(spark, sf_dir), ["dialog_id"]).withColumn(
        "f1", F.round("f1", 6))


@query(with_(F1, "SELECT count(*) AS n_rows, round(avg(em), 6) AS em FROM f1 WHERE gold_no = 0"))
def corpus_em(spark, sf_dir):
    return answers.corpus_exact_match(predictions(spark, sf_dir)).withColumn(
        "em", F.round("em", 6))


@query(with_(F1, "SELECT count(*) AS n_questions, round(100 * avg(em), 6) AS exact_match, "
                 "round(100 * avg(f1), 6) AS f1 FROM (SELECT dialog_id, max(em) AS em, "
                 "max(f1) AS f1 FROM f1 GROUP BY dialog_id)"))
def squad_metrics(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    golds = rows.select("dialog_id", F.lit(0).alias("gold_no"), "prediction", "gold").unionByName(
        rows.select("dialog_id", F.lit(1).alias("gold_no"), "prediction",
                    F.col("question").alias("gold")))
    scores = answers.squad_scores(golds, "dialog_id", "gold_no")
    return scores.select("n_questions", F.round("exact_match", 6).alias("exact_match"),
                         F.round("f1", 6).alias("f1"))


@query(with_(DIALOGUES, "SELECT CAST(to_json({id: CAST(dialog_id AS VARCHAR), answer: answer}) "
                        "AS VARCHAR) AS line FROM dialogues"))
def prediction_export(spark, sf_dir):
    return retrieval.prediction_lines(
        dialogues(spark, sf_dir).select(F.col("dialog_id").alias("id"), "answer"))


# Three "answers" per neighbour: its label, and two labels made from it, with
# log-probabilities derived from the ids.
_DRAFTS = {
    **NEIGHBOURS,
    "drafts": "SELECT row_id AS question_id, passage_id, score AS doc_score, "
              "'label ' || ((class + d) % 10) AS answer, "
              "-(1.0 + (passage_id % 7) / 10.0 + d) AS logprob FROM near, range(3) r(d) "
              "WHERE rank <= 5",
    "docs": "SELECT question_id, passage_id, doc_score - ln(sum(exp(doc_score)) OVER "
            "(PARTITION BY question_id)) AS lp FROM (SELECT DISTINCT question_id, passage_id, "
            "doc_score FROM drafts)",
    "joint": "SELECT question_id, answer, round(ln(sum(exp(lp + logprob))), 9) AS logprob "
             "FROM drafts JOIN docs USING (question_id, passage_id) GROUP BY ALL",
}


def _neighbours(spark, sf_dir, k):
    """The k nearest other vectors of every vector, with both labels."""
    stored = vectors(spark, sf_dir)
    asked = stored.select(F.col("passage_id").alias("question_id"), "vector")
    found = scoring.top_passages(asked, stored, k + 1).where(
        F.col("question_id") != F.col("passage_id"))
    others = scoring.rank_top(found, k)
    label = stored.select("passage_id", F.col("label").alias("class"))
    target = stored.select(F.col("passage_id").alias("question_id"), F.col("label").alias("target"))
    return others.join(label, "passage_id").join(target, "question_id")


@query(with_(_DRAFTS, "SELECT question_id, answer, logprob FROM joint QUALIFY "
                      "row_number() OVER (PARTITION BY question_id ORDER BY logprob DESC, answer) "
                      "= 1"))
def marginalize_answers(spark, sf_dir):
    drafts = (
        _neighbours(spark, sf_dir, 5)
        .withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(2))))
        .select("question_id", "passage_id", F.col("score").alias("doc_score"),
                F.concat(F.lit("label "), ((F.col("class") + F.col("d")) % 10).cast("string"))
                .alias("answer"),
                (-(1.0 + F.col("passage_id") % 7 / 10.0 + F.col("d"))).alias("logprob"))
    )
    return answers.marginalize_answers(drafts)


_EVENTS = {
    "batches": "SELECT date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS epoch, "
               "CASE WHEN user_id % 2 = 0 THEN 'train' ELSE 'val' END AS split, event_type AS name, "
               "hour(ts) AS batch, avg(value) AS value, count(*) AS n_rows FROM events GROUP BY ALL",
}


@query(with_(_EVENTS, "SELECT epoch, split, name, count(*) AS n_batches, round(avg(value) + 1e-10, 6) AS "
                      "batch_mean, round(sum(value * n_rows) / sum(n_rows) + 1e-10, 6) AS row_mean "
                      "FROM batches GROUP BY ALL"))
def batch_metric_mean(spark, sf_dir):
    epoch = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    split = F.when(F.col("user_id") % 2 == 0, F.lit("train")).otherwise(F.lit("val"))
    batches = (
        table(spark, sf_dir, "events")
        .groupBy(epoch.alias("epoch"), split.alias("split"), F.col("event_type").alias("name"),
                 F.hour("ts").alias("batch"))
        .agg(F.avg("value").alias("value"), F.count("*").alias("n_rows"))
    )
    # Means of two-decimal values often end in an exact half at the seventh digit;
    # the nudge rounds them alike whatever the order of the sum.
    return metrics.batch_means(batches).withColumns(
        {c: F.round(F.col(c) + 1e-10, 6) for c in ("batch_mean", "row_mean")})


@query(with_({**NEIGHBOURS,
              "classes": "SELECT row_id, target, class, round(sum(score), 9) AS score FROM near "
                         "GROUP BY ALL",
              "best": "SELECT row_id, target, class AS pred FROM classes QUALIFY row_number() OVER "
                      "(PARTITION BY row_id ORDER BY score DESC, class) = 1"},
             "SELECT count(*) AS n_rows, round(avg(CAST(pred = target AS INT)), 6) AS accuracy "
             "FROM best"))
def argmax_accuracy(spark, sf_dir):
    scores = (
        _neighbours(spark, sf_dir, 20)
        .groupBy(F.col("question_id").alias("row_id"), "target", "class")
        .agg(F.round(F.sum("score"), 9).alias("score"))
    )
    return metrics.argmax_accuracy(scores).withColumn("accuracy", F.round("accuracy", 6))


@query(with_(NEIGHBOURS, "SELECT target, class AS pred, count(*) AS n FROM near WHERE rank = 1 "
                         "GROUP BY ALL"))
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(
        _neighbours(spark, sf_dir, 1).withColumnRenamed("class", "pred"))


_RULE = "SELECT quality AS target, CAST(n_chars > 400 AS INT) AS pred FROM labels JOIN documents " \
        "USING (doc_id)"


@query(f"""WITH rows_ AS ({_RULE}),
c AS (SELECT target AS class FROM rows_ UNION SELECT pred FROM rows_),
s AS (SELECT class, (SELECT count(*) FROM rows_ WHERE target = class) AS support,
  (SELECT count(*) FROM rows_ WHERE pred = class) AS said,
  (SELECT count(*) FROM rows_ WHERE pred = class AND target = class) AS hit FROM c)
SELECT class, support, round(CASE WHEN said > 0 THEN hit / said ELSE 0.0 END, 6) AS precision,
round(CASE WHEN support > 0 THEN hit / support ELSE 0.0 END, 6) AS recall,
round(CASE WHEN said + support > 0 THEN 2 * hit / (said + support) ELSE 0.0 END, 6) AS f1 FROM s""")
def per_class_prf(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id").select(
        F.col("quality").alias("target"), (F.col("n_chars") > 400).cast("int").alias("pred"))
    return metrics.class_scores(rows).withColumns(
        {c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(with_(HISTORY, "SELECT run, name, epoch, round(value, 6) AS value, round(max(value) OVER "
                      "(PARTITION BY run, name ORDER BY epoch), 6) AS best FROM history"))
def best_so_far(spark, sf_dir):
    return metrics.best_so_far(history(spark, sf_dir)).withColumns(
        {c: F.round(c, 6) for c in ("value", "best")})


@query(with_(HISTORY, "SELECT 'max' AS mode, run, name, epoch, round(value, 6) AS value FROM "
                      "history QUALIFY row_number() OVER (PARTITION BY run, name ORDER BY value "
                      "DESC, epoch) = 1 UNION ALL SELECT 'min', run, name, epoch, "
                      "round(value, 6) FROM history QUALIFY row_number() OVER "
                      "(PARTITION BY run, name ORDER BY value, epoch) = 1"))
def best_epoch(spark, sf_dir):
    rows = history(spark, sf_dir)
    high = metrics.best_epoch(rows).withColumn("mode", F.lit("max"))
    low = metrics.best_epoch(rows, lower_is_better=True).withColumn("mode", F.lit("min"))
    return high.unionByName(low).select("mode", "run", "name", "epoch",
                                        F.round("value", 6).alias("value"))
