"""Prompts, token sets, batches and contrastive losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from answerloom.functions import text as X
from answerloom.operators import (
    answers, batches, chunking, contrastive, metrics, numbering, qa, redraw, tokens)
from answerloom.operators.stored import written_once
from answerloom.plans.corpus import passage_input
from answerloom.registry.base import (
    benchmark_questions, dialogues, passage_table, passages, predictions, qa_rows, query, table, vector_pairs, vectors)
from answerloom.registry.corpus import CHUNKED_QA
from answerloom.registry.sql import (
    BENCHMARK, DIALOGUES, PASSAGES, PREDICTIONS, QA, VECTORS, batches as sql_batches, encoded, normalized,
    tokens as sql_tokens, vocabulary, with_)

BATCH = 16


def _ids(name):
    return F.array_join(F.transform(name, lambda x: x.cast("string")), " ")


@query(with_(QA, "SELECT qa_id, '제목: ' || title || ' 질문: ' || question || '  글: ' || context "
                 "|| ' </s>' AS source, answer || ' </s>' AS target FROM qa"))
def qa_prompts(spark, sf_dir):
    return qa_rows(spark, sf_dir).select(
        "qa_id", X.qa_prompt(F.col("question"), F.col("context"), F.col("title")).alias("source"),
        X.qa_target(F.col("answer")).alias("target"))


@query(with_(QA, "SELECT qa_id, '질문: ' || question || '  글: ' || context || ' </s>' AS source, "
                 "answer || ' </s>' AS target FROM qa"))
def qa_prompts_untitled(spark, sf_dir):
    return qa_rows(spark, sf_dir).select(
        "qa_id", X.qa_prompt(F.col("question"), F.col("context")).alias("source"),
        X.qa_target(F.col("answer")).alias("target"))


def _corpus_vocabulary(spark, sf_dir):
    return tokens.vocabulary(table(spark, sf_dir, "conversations"), "text")


def _document_vocabulary(spark, sf_dir):
    """Learned from the texts and titles that the pairs are made of."""
    texts = table(spark, sf_dir, "documents").select(F.concat_ws(" ", "lang", "text").alias("text"))
    return tokens.vocabulary(texts, "text")


_VOCAB = vocabulary("conversations", "text")
_PAIR_VOCAB = vocabulary("documents", "concat_ws(' ', lang, text)")


@query(with_(_VOCAB, "SELECT token, CAST(token_id AS INT) AS token_id FROM vocab"))
def vocabulary_table(spark, sf_dir):
    return _corpus_vocabulary(spark, sf_dir)


def _joined(x):
    return f"array_to_string({x}, ' ')"


_FRAMED = "list_concat([2], ids, [3])"


def _padded(x, n):
    return f"list_resize({x}, {n}, 0)"


def _mask(size, n):
    return f"list_transform(range({n}), lambda k: CASE WHEN k < {size} THEN 1 ELSE 0 END)"


@query(with_({**_VOCAB, **DIALOGUES, **encoded("e", "dialogues", "dialog_id", "question", 254)},
             f"SELECT dialog_id, {_joined(_padded(_FRAMED, 256))} AS input_ids, "
             f"{_joined(_mask('len(ids) + 2', 256))} AS attention_mask, "
             f"{_joined(_mask('0', 256))} AS token_type_ids FROM e"))
def encode_questions(spark, sf_dir):
    rows = tokens.encode_questions(dialogues(spark, sf_dir), "dialog_id", "question",
                                   _corpus_vocabulary(spark, sf_dir))
    return rows.select("dialog_id", *[_ids(c).alias(c) for c in (
        "input_ids", "attention_mask", "token_type_ids")])


_PAIRS = {
    **_PAIR_VOCAB, **PASSAGES,
    "titled": "SELECT passage_id, '제목: ' || title || ' 글: ' AS title, text FROM passages",
    **encoded("ta", "titled", "passage_id", "title", 253),
    **encoded("tb", "titled", "passage_id", "text", 253),
    # Drop one token at a time from the longer side: the first part keeps the
    # larger half when both are long.
    "cut": "SELECT passage_id, ta.ids[1:greatest(127, 253 - len(tb.ids))] AS a, tb.ids AS b FROM ta "
           "JOIN tb USING (passage_id)",
    "trimmed": "SELECT passage_id, a, b[1:253 - len(a)] AS b FROM cut",
}


@query(with_(_PAIRS, "SELECT passage_id, "
             f"{_joined(_padded('list_concat([2], a, [3], b, [3])', 256))} AS input_ids, "
             f"{_joined(_mask('len(a) + len(b) + 3', 256))} AS attention_mask, "
             "array_to_string(list_transform(range(256), lambda k: CASE WHEN k >= len(a) + 2 AND "
             "k < len(a) + len(b) + 3 THEN 1 ELSE 0 END), ' ') AS token_type_ids FROM trimmed"))
def encode_pairs(spark, sf_dir):
    titled = passages(spark, sf_dir).withColumn("title", X.decorate_title(F.col("title")))
    rows = tokens.encode_pairs(titled, "passage_id", "title", "text",
                               _document_vocabulary(spark, sf_dir))
    return rows.select("passage_id", *[_ids(c).alias(c) for c in (
        "input_ids", "attention_mask", "token_type_ids")])


_TRAINING = {
    **_PAIR_VOCAB, **CHUNKED_QA,
    "asked": "SELECT qa_id, article_id, paragraph_id, question, '제목: ' || title || ' 글: ' AS "
             "title, text FROM chunked_qa WHERE coalesce(question, '') <> ''",
    **encoded("tq", "asked", "qa_id", "question", 254),
    **encoded("ta", "asked", "qa_id", "title", 253),
    **encoded("tb", "asked", "qa_id", "text", 253),
    "long": "SELECT qa_id, ta.ids[1:greatest(127, 253 - len(tb.ids))] AS a, tb.ids AS b FROM ta "
            "JOIN tb USING (qa_id)",
    "trimmed": "SELECT qa_id, a, b[1:253 - len(a)] AS b FROM long",
}


@query(with_(_TRAINING, "SELECT qa_id, article_id, paragraph_id, "
             f"{_joined(_padded('list_concat([2], q.ids, [3])', 256))} AS question_input_ids, "
             f"{_joined(_padded('list_concat([2], a, [3], b, [3])', 256))} AS context_input_ids, "
             "len(q.ids) + 2 AS question_tokens, len(a) + len(b) + 3 AS context_tokens, "
             "len(b) + 1 AS text_tokens FROM trimmed JOIN tq q USING (qa_id) "
             "JOIN asked USING (qa_id)"))
def training_pairs(spark, sf_dir):
    pairs = qa.has_question(chunking.chunk_qa(qa_rows(spark, sf_dir))).withColumn(
        "title", X.decorate_title(F.col("title")))
    rows = tokens.encode_training_pairs(pairs, "qa_id", _document_vocabulary(spark, sf_dir))
    ones = lambda name: F.aggregate(name, F.lit(0), lambda acc, x: acc + x)
    return rows.select(
        "qa_id", "article_id", "paragraph_id", _ids("question_input_ids").alias("question_input_ids"),
        _ids("context_input_ids").alias("context_input_ids"),
        ones("question_attention_mask").alias("question_tokens"),
        ones("context_attention_mask").alias("context_tokens"),
        ones("context_token_type_ids").alias("text_tokens"))


_SEQ = {
    **_VOCAB, **DIALOGUES,
    "prompted": "SELECT dialog_id, conv_id, turn, '질문: ' || question || ' </s>' AS source, "
                "answer || ' </s>' AS target FROM dialogues",
    **encoded("src", "prompted", "dialog_id", "source", 1024),
    **encoded("tgt", "prompted", "dialog_id", "target", 128),
}


def _sequences(spark, sf_dir):
    rows = dialogues(spark, sf_dir).select(
        "dialog_id", F.concat(F.lit(X.QUESTION_TAG), "question", F.lit(X.END_TAG)).alias("source"),
        X.qa_target(F.col("answer")).alias("target"))
    return tokens.encode_seq2seq(rows, "dialog_id", "source", "target",
                                 _corpus_vocabulary(spark, sf_dir))


@query(with_(_SEQ, f"SELECT dialog_id, {_joined('src.ids')} AS input_ids, "
                   f"{_joined('list_transform(src.ids, lambda x: 1)')} AS attention_mask, "
                   f"{_joined('tgt.ids')} AS labels FROM src JOIN tgt USING (dialog_id)"))
def encode_seq2seq(spark, sf_dir):
    return _sequences(spark, sf_dir).select("dialog_id", *[_ids(c).alias(c) for c in (
        "input_ids", "attention_mask", "labels")])


_DECODED = (r"array_to_string(list_filter({0}[1:{1}], lambda t: t NOT IN ('제목:', '글:', '질문:', '</s>')), ' ')")


@query(with_(DIALOGUES, "SELECT dialog_id, " + _DECODED.format(sql_tokens("answer || ' </s>'"), 128)
             + " AS text FROM dialogues"))
def decode_answers(spark, sf_dir):
    """Answers encoded as labels and read back."""
    return tokens.decode(_sequences(spark, sf_dir), "dialog_id", "labels", _corpus_vocabulary(spark, sf_dir))


_SIDES = {name: normalized(_DECODED.format(sql_tokens(name), 1024)) for name in ("prediction", "gold")}


@query(with_(PREDICTIONS, f"SELECT count(*) AS n_rows, round(avg(CAST({_SIDES['prediction']} = {_SIDES['gold']} "
                          "AS INT)), 6) AS em FROM predictions"))
def decoded_em(spark, sf_dir):
    """Exact match of predictions and answers that went through token ids."""
    vocab = written_once(_corpus_vocabulary(spark, sf_dir))
    ids = tokens.encode(predictions(spark, sf_dir), "dialog_id", {"p": ("prediction", 1024), "g": ("gold", 1024)}, vocab)
    ids = written_once(ids)
    said = tokens.decode(ids, "dialog_id", "p", vocab).withColumnRenamed("text", "prediction")
    meant = tokens.decode(ids, "dialog_id", "g", vocab).withColumnRenamed("text", "gold")
    return answers.corpus_exact_match(said.join(meant, "dialog_id")).withColumn("em", F.round("em", 6))


_BATCHED = {**_SEQ, **sql_batches("bt", "prompted", ["dialog_id"], BATCH),
            "rows_": "SELECT dialog_id, batch_id, src.ids AS ids, tgt.ids AS labels FROM bt "
                     "JOIN src USING (dialog_id) JOIN tgt USING (dialog_id)"}


@query(with_({**DIALOGUES, **sql_batches("bt", "dialogues", ["dialog_id"], BATCH)},
             "SELECT dialog_id, batch_id, slot FROM bt"))
def fixed_batches(spark, sf_dir):
    rows = dialogues(spark, sf_dir).select("dialog_id")
    return numbering.fixed_batches(rows, ["dialog_id"], BATCH)


def _batched(spark, sf_dir):
    return _sequences(spark, sf_dir).join(fixed_batches(spark, sf_dir), "dialog_id")


@query(with_({**_BATCHED, "longest": "SELECT batch_id, max(len(ids)) AS n FROM rows_ GROUP BY ALL"},
             f"SELECT dialog_id, batch_id, {_joined(_padded('ids', 'n'))} AS input_ids FROM rows_ "
             "JOIN longest USING (batch_id)"))
def pad_batches(spark, sf_dir):
    padded = tokens.pad_batches(_batched(spark, sf_dir), "input_ids")
    return padded.select("dialog_id", "batch_id", _ids("input_ids").alias("input_ids"))


@query(with_({**_BATCHED, "longest": "SELECT batch_id, max(len(ids)) AS n FROM rows_ GROUP BY ALL"},
             f"SELECT dialog_id, batch_id, {_joined(_padded('ids', 'n'))} AS ids, "
             f"{_joined(_mask('len(ids)', 'n'))} AS mask FROM rows_ JOIN longest USING (batch_id)"))
def trim_batches(spark, sf_dir):
    full = _batched(spark, sf_dir).select(
        "dialog_id", "batch_id", tokens.mask_to(F.col("input_ids"), 1024).alias("mask"),
        tokens.pad_to(F.col("input_ids"), 1024).alias("ids"))
    trimmed = tokens.trim_batches(full, ["ids", "mask"])
    return trimmed.select("dialog_id", "batch_id", _ids("ids").alias("ids"),
                          _ids("mask").alias("mask"))


@query(with_(_BATCHED, "SELECT batch_id, count(*) AS n_rows, CAST(sum(len(ids) + len(labels)) AS "
                       "BIGINT) AS n_tokens, round(avg(len(labels)), 6) AS mean_target_length "
                       "FROM rows_ GROUP BY batch_id"))
def tokens_per_batch(spark, sf_dir):
    counted = tokens.batch_tokens(_batched(spark, sf_dir), "input_ids", "labels")
    return counted.withColumn("mean_target_length", F.round("mean_target_length", 6))


@query("""
WITH runs AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day, min(ts) AS started, max(ts) AS ended, count(*) AS items
              FROM events GROUP BY ALL),
timed AS (SELECT event_type, items, epoch_us(ended) - epoch_us(started) AS micros FROM runs)
SELECT event_type, count(*) AS n_batches, CAST(sum(items) AS BIGINT) AS n_items,
       round(sum(micros) / sum(items) / 1000000, 6) AS seconds_per_item,
       round(avg(micros / items) / 1000000, 6) AS batch_mean_seconds
FROM timed GROUP BY event_type
""")
def time_per_item(spark, sf_dir):
    """A user's events of one kind and day are a batch that runs from the first to the last."""
    runs = table(spark, sf_dir, "events").groupBy("event_type", "user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count("*").alias("items"))
    return metrics.item_times(runs, "event_type").withColumns(
        {c: F.round(c, 6) for c in ("seconds_per_item", "batch_mean_seconds")})


def _batch_pairs(spark, sf_dir):
    return vector_pairs(spark, sf_dir).withColumn(
        "batch_id", F.floor(F.col("pair_id") / BATCH))


@query(with_({**VECTORS,
              "s": f"SELECT question_id // {BATCH} AS batch_id, question_id, passage_id, score, "
                   f"row_number() OVER (PARTITION BY question_id ORDER BY score DESC, passage_id) "
                   f"AS rank FROM scored WHERE question_id // {BATCH} = passage_id // {BATCH}",
              "q": "SELECT batch_id, question_id, ln(sum(exp(score / 0.5))) - sum(score / 0.5) "
                   "FILTER (question_id = passage_id) AS loss, CAST(min(rank) FILTER "
                   "(question_id = passage_id) = 1 AS INT) AS hit FROM s GROUP BY ALL"},
             "SELECT batch_id, count(*) AS n_pairs, round(avg(loss), 6) AS loss, "
             "round(avg(hit), 6) AS accuracy FROM q GROUP BY batch_id"))
def inbatch_loss(spark, sf_dir):
    return contrastive.in_batch_loss(_batch_pairs(spark, sf_dir), temperature=0.5).withColumns(
        {c: F.round(c, 6) for c in ("loss", "accuracy")})


_WITH_GOLD = ("SELECT *, max(score) FILTER (question_id = passage_id) OVER (PARTITION BY question_id) "
              "AS gold_score FROM scored")


@query(with_({**VECTORS, "w": _WITH_GOLD},
             "SELECT question_id, round(ln(exp(any_value(gold_score) / 0.5) + sum(exp(0.999 * score / 0.5))) "
             "- any_value(gold_score) / 0.5, 6) AS loss, count(*) AS n_negatives, "
             "count(*) FILTER (round(0.999 * score, 9) > gold_score) + 1 AS positive_rank "
             "FROM w GROUP BY question_id"))
def corpus_contrastive_loss(spark, sf_dir):
    return contrastive.corpus_loss(vector_pairs(spark, sf_dir), vectors(spark, sf_dir),
                                   temperature=0.5).withColumn("loss", F.round("loss", 6))


def _sequence(spark, sf_dir):
    return vector_pairs(spark, sf_dir).withColumnRenamed("pair_id", "seq")


@query(with_({"k": "SELECT vec_id AS seq FROM embeddings",
              "b": f"SELECT DISTINCT seq // {BATCH} AS batch_id FROM k"},
             f"SELECT batch_id, seq AS key_seq FROM b JOIN k ON seq BETWEEN batch_id * {BATCH} - 64 "
             f"AND batch_id * {BATCH} - 1"))
def queue_negatives(spark, sf_dir):
    keys = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("seq"))
    return contrastive.queue_negatives(keys, 64, BATCH)


_QUEUED = {
    **{name: text for name, text in VECTORS.items() if name in ("vec", "vlong", "qlong", "qv")},
    "near": "SELECT question_id AS seq, passage_id, round(list_dot_product(qv.v, vec.v), 9) AS score FROM qv "
            f"JOIN vec ON passage_id BETWEEN question_id // {BATCH} * {BATCH} - 64 AND question_id",
    "queued": "SELECT *, max(score) FILTER (seq = passage_id) OVER (PARTITION BY seq) AS gold_score, "
              f"passage_id < seq // {BATCH} * {BATCH} AS negative FROM near",
}


@query(with_({"k": "SELECT DISTINCT vec_id // " + str(BATCH) + " AS batch_id FROM embeddings"},
             f"SELECT batch_id, greatest(0, batch_id * {BATCH} - 64) AS first_seq, batch_id * {BATCH} - 1 AS last_seq "
             "FROM k WHERE batch_id > 0"))
def queue_ranges(spark, sf_dir):
    keys = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("seq"))
    return contrastive.queue_ranges(keys, 64, BATCH)


@query(with_(_QUEUED,
             "SELECT seq, round(ln(exp(any_value(gold_score) / 0.5) + coalesce(sum(exp(score / 0.5)) FILTER "
             "(negative), 0.0)) - any_value(gold_score) / 0.5, 6) AS loss, count(*) FILTER (negative AND "
             "score > gold_score) + 1 AS positive_rank, count(*) FILTER (negative) AS n_negatives "
             "FROM queued GROUP BY seq"))
def queue_loss(spark, sf_dir):
    return contrastive.queue_loss(_sequence(spark, sf_dir), 64, BATCH, 0.5).withColumn(
        "loss", F.round("loss", 6))


def _pair_rows(spark, sf_dir):
    return passage_table(spark, sf_dir).select(
        F.col("passage_id").alias("row_id"), "article_id", "paragraph_id")


def _drawn(text):
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _rounds(seed):
    """slots: batch_id, slot, round and article of permutations of all articles, cut into batches."""
    return {
        "homes": "SELECT article_id, count(*) AS n, count(DISTINCT paragraph_id) AS n_sheets FROM passages GROUP BY 1",
        "sizes": f"SELECT (SELECT count(*) FROM homes) // {BATCH} AS per_round, count(*) // {BATCH} AS n_batches "
                 "FROM passages",
        "dealt": "SELECT *, row_number() OVER (PARTITION BY round ORDER BY "
                 f"md5(concat_ws('-', '{seed}', round, article_id))) - 1 AS pos FROM sizes, LATERAL (SELECT "
                 "unnest(range(CAST(ceil(n_batches / per_round) AS BIGINT))) AS round), homes",
        "slots": f"SELECT round * per_round + pos // {BATCH} AS batch_id, CAST(pos % {BATCH} AS INT) AS slot, round, "
                 f"article_id, n, n_sheets FROM dealt WHERE pos // {BATCH} < per_round AND "
                 f"round * per_round + pos // {BATCH} < n_batches",
    }


def _easy(seed):
    return {
        **PASSAGES, **_rounds(seed),
        "laid": "SELECT passage_id AS row_id, article_id, row_number() OVER (PARTITION BY article_id ORDER BY "
                f"md5(concat_ws('-', '{seed}', passage_id))) - 1 AS pos FROM passages",
        "easy": "SELECT batch_id, slot, row_id, s.article_id FROM slots s JOIN laid l ON l.article_id = s.article_id "
                "AND l.pos = " + _drawn(f"concat_ws('-', '{31 * seed + 1}', round, s.article_id)") + " % n",
    }


def _hard(seed):
    def drawn(salt, *ids):
        return _drawn(f"concat_ws('-', '{31 * seed + salt}', {', '.join(ids)})")

    return {
        **PASSAGES, **_rounds(seed),
        "sheets": "SELECT article_id, paragraph_id, count(*) AS n_rows, row_number() OVER (PARTITION BY article_id "
                  f"ORDER BY md5(concat_ws('-', '{seed}', paragraph_id))) - 1 AS sheet FROM passages GROUP BY 1, 2",
        "laid": "SELECT passage_id AS row_id, article_id, paragraph_id, row_number() OVER (PARTITION BY article_id, "
                f"paragraph_id ORDER BY md5(concat_ws('-', '{seed}', passage_id))) - 1 AS pos FROM passages",
        "met": "SELECT o.batch_id, o.slot, o.round, CASE WHEN e.n_sheets > 1 THEN e.article_id ELSE o.article_id END "
               "AS article_id, CASE WHEN e.n_sheets > 1 THEN e.n_sheets ELSE o.n_sheets END AS n_sheets, "
               "o.slot % 2 = 1 AND e.n_sheets > 1 AS ahead FROM slots o JOIN slots e ON e.batch_id = o.batch_id AND "
               "e.slot = o.slot - o.slot % 2",
        "chosen": "SELECT batch_id, slot, article_id, (" + drawn(2, "round", "article_id") + " % n_sheets + CASE WHEN "
                  "ahead THEN 1 + " + drawn(3, "round", "article_id") + " % greatest(n_sheets - 1, 1) ELSE 0 END) "
                  "% n_sheets AS sheet FROM met",
        "hard": "SELECT batch_id, slot, row_id, c.article_id, s.paragraph_id FROM chosen c JOIN sheets s ON "
                "s.article_id = c.article_id AND s.sheet = c.sheet JOIN laid l ON l.article_id = c.article_id AND "
                "l.paragraph_id = s.paragraph_id AND l.pos = " + drawn(4, "batch_id", "slot") + " % n_rows",
    }


@query(with_(_easy(7), "SELECT * FROM easy"))
def easy_batches(spark, sf_dir):
    return batches.easy_batches(_pair_rows(spark, sf_dir), BATCH)


@query(with_(_hard(8), "SELECT * FROM hard"))
def hard_batches(spark, sf_dir):
    return batches.hard_batches(_pair_rows(spark, sf_dir), BATCH)


@query(f"SELECT *, 7 AS seed FROM ({with_(_easy(7), 'SELECT * FROM easy')}) UNION ALL "
       f"SELECT batch_id, slot, row_id, article_id, 8 FROM ({with_(_hard(8), 'SELECT * FROM hard')})")
def epoch_batches(spark, sf_dir):
    """An odd and an even epoch: easy batches, then hard ones."""
    rows = _pair_rows(spark, sf_dir)
    return batches.epoch_batches(rows, BATCH, 7).withColumn("seed", F.lit(7)).unionByName(
        batches.epoch_batches(rows, BATCH, 8).withColumn("seed", F.lit(8)))


def _redrawn(seed):
    """(batch_id, slot, article): the walk of every slot through the keyed permutation."""
    turns = ", ".join(
        (f"(l{i} + " + _drawn(f"concat_ws('-', '{seed}', batch_id, {i}, r{i})") + f") % a AS l{i + 1}, r{i} AS r{i + 1}")
        if i % 2 == 0 else
        (f"l{i} AS l{i + 1}, (r{i} + " + _drawn(f"concat_ws('-', '{seed}', batch_id, {i}, l{i})")
         + f") % b AS r{i + 1}") for i in range(redraw.ROUNDS))
    last = redraw.ROUNDS
    return {
        **PASSAGES,
        "laid": "SELECT passage_id AS row_id, article_id, paragraph_id, row_number() OVER (ORDER BY article_id, "
                "paragraph_id, passage_id) - 1 AS pos FROM passages WHERE article_id IS NOT NULL",
        "sheets": "SELECT *, row_number() OVER (ORDER BY article_id, paragraph_id) - 1 AS sheet FROM (SELECT "
                  "article_id, paragraph_id, min(pos) AS lo, count(*) AS n_rows FROM laid GROUP BY ALL)",
        "homes": "SELECT *, row_number() OVER (ORDER BY article_id) - 1 AS article FROM (SELECT article_id, "
                 "min(lo) AS lo, sum(n_rows)::BIGINT AS n_rows, min(sheet) AS first, count(*) AS n FROM sheets "
                 "GROUP BY article_id)",
        "sizes": f"SELECT s, a, CAST(ceil(s / a) AS BIGINT) AS b, (SELECT count(*) FROM laid) // {BATCH} AS n_batches "
                 "FROM (SELECT count(*) AS s, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM homes)",
        "walk": "SELECT batch_id, CAST(slot AS INT) AS slot, slot AS x, 0 AS step, s, a, b FROM sizes, "
                f"LATERAL (SELECT unnest(range(n_batches)) AS batch_id), range({BATCH}) t(slot) UNION ALL "
                f"SELECT batch_id, slot, l{last} * b + r{last}, step + 1, s, a, b FROM (SELECT *, x // b AS l0, "
                f"x % b AS r0, {turns} FROM walk WHERE step = 0 OR x >= s)",
        "drawn": "SELECT batch_id, slot, x AS article FROM walk WHERE step > 0 AND x < s",
    }


@query(with_(_redrawn(7), "SELECT batch_id, slot, row_id, laid.article_id FROM drawn JOIN homes USING (article) JOIN laid "
                          "ON pos = lo + " + _drawn("concat_ws('-', '8', batch_id, slot)") + " % n_rows"))
def redrawn_batches(spark, sf_dir):
    return redraw.redrawn_batches(_pair_rows(spark, sf_dir), BATCH, 7)


_HARD_REDRAWN = {
    **_redrawn(8),
    "pairs": "SELECT o.batch_id, o.slot, h.first, h.n, g.first AS lead_first, g.n AS lead_n FROM drawn o JOIN homes h "
             "ON h.article = o.article JOIN drawn l ON l.batch_id = o.batch_id AND l.slot = o.slot - o.slot % 2 "
             "JOIN homes g ON g.article = l.article",
    "turned": "SELECT *, " + _drawn("concat_ws('-', '9', batch_id, slot - slot % 2)") + " % lead_n AS one, "
              + _drawn("concat_ws('-', '10', batch_id, slot)") + " % greatest(lead_n - 1, 1) AS ahead FROM pairs",
    "chosen": "SELECT batch_id, slot, CASE WHEN slot % 2 = 0 THEN lead_first + one WHEN lead_n > 1 THEN "
              "lead_first + (one + 1 + ahead) % lead_n ELSE first + "
              + _drawn("concat_ws('-', '9', batch_id, slot)") + " % n END AS sheet FROM turned",
}


@query(with_(_HARD_REDRAWN, "SELECT batch_id, slot, row_id, laid.article_id, laid.paragraph_id FROM chosen JOIN sheets "
                            "USING (sheet) JOIN laid ON pos = lo + "
                            + _drawn("concat_ws('-', '11', batch_id, slot)") + " % n_rows"))
def redrawn_hard_batches(spark, sf_dir):
    return redraw.redrawn_hard_batches(_pair_rows(spark, sf_dir), BATCH, 8)


_NEGATIVE_RANKS = {
    **_QUEUED,
    "corpus": "SELECT qv.question_id AS seq, passage_id, round(list_dot_product(qv.v, vec.v), 9) AS score "
              "FROM qv CROSS JOIN vec",
    "ranked": "SELECT 'corpus' AS negatives, seq, count(*) FILTER (round(0.999 * score, 9) > gold_score) + 1 AS r "
              "FROM (SELECT *, max(score) FILTER (seq = passage_id) OVER (PARTITION BY seq) AS gold_score "
              "FROM corpus) GROUP BY seq UNION ALL SELECT 'queue', seq, count(*) FILTER (negative AND "
              "score > gold_score) + 1 FROM queued GROUP BY seq",
}


@query(with_(_NEGATIVE_RANKS, "SELECT negatives, k, round(100 * avg(CAST(r <= k AS INT)), 6) AS precision "
                              "FROM ranked, (VALUES (1), (5), (10)) t(k) GROUP BY ALL"))
def negatives_accuracy(spark, sf_dir):
    """Accuracy@k of the positive against the scaled corpus and against the queue."""
    pairs = written_once(vector_pairs(spark, sf_dir))
    corpus = contrastive.corpus_ranks(pairs, vectors(spark, sf_dir))
    queued = contrastive.queue_loss(pairs.withColumnRenamed("pair_id", "seq"), 64, BATCH, 0.5)
    parts = [
        contrastive.precision_at(losses.withColumnRenamed("positive_rank", "gold_rank"), (1, 5, 10)).select(
            F.lit(name).alias("negatives"), "k", F.round("precision", 6).alias("precision"))
        for name, losses in (("corpus", corpus), ("queue", queued))]
    return parts[0].unionByName(parts[1])


@query(with_({**PASSAGES, "n": f"SELECT count(*) // {BATCH} AS b FROM passages"},
             f"SELECT mode, b AS n_batches, b * {BATCH} AS n_rows, CAST(0 AS BIGINT) AS n_broken "
             "FROM n, (VALUES ('easy'), ('hard')) t(mode)"))
def batch_audit(spark, sf_dir):
    """Batch counts, and batches that break the rule of their kind.

    Easy: distinct articles.  Hard: distinct passages, and no article more than
    twice.
    """
    rows = _pair_rows(spark, sf_dir)
    easy = batches.easy_batches(rows, BATCH).groupBy("batch_id").agg(
        F.count("*").alias("n"), (F.count_distinct("article_id") == BATCH).alias("ok"))
    per_article = batches.hard_batches(rows, BATCH).groupBy("batch_id", "article_id").agg(
        F.count("*").alias("n"), F.count_distinct("paragraph_id").alias("p"))
    hard = per_article.groupBy("batch_id").agg(
        F.sum("n").alias("n"), ((F.max("n") <= 2) & (F.sum("n") == F.sum("p"))).alias("ok"))
    audit = lambda t, mode: t.agg(
        F.count("*").alias("n_batches"), F.sum("n").alias("n_rows"),
        F.count_if(~F.col("ok")).alias("n_broken")).withColumn("mode", F.lit(mode))
    return audit(easy, "easy").unionByName(audit(hard, "hard"))
