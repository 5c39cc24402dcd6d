"""Cleaning, duplicates, chunking, ids and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from answerloom.functions import ids as I
from answerloom.functions import text as X
from answerloom.operators import chunking, dedup, qa, sentences, splits
from answerloom.operators.skew import use_all_cores
from answerloom.plans.corpus import clean_articles
from answerloom.registry.base import (
    articles, dialogues, passages, qa_rows, query, table, validation_questions, wide_articles)
from answerloom.registry.sql import (
    ARTICLES, DIALOGUES, PASSAGES, QA, VALIDATION, canonical, chunks, clean, in_test,
    sentence_list, with_)
from answerloom.sources.tables import parse_dump, with_split


@query(with_(ARTICLES, "SELECT CAST(article_id AS VARCHAR) AS row_key, article_id, title, text "
                       "FROM articles"))
def load_articles(spark, sf_dir):
    rows = articles(spark, sf_dir)
    article = F.struct("text", "title", F.col("article_id").alias("document_id"),
                       F.length("text").alias("other"))
    dump = rows.select(F.to_json(F.create_map(F.col("article_id").cast("string"), article))
                       .alias("value"))
    return parse_dump(dump)


SPLIT = (f"SELECT doc_id, lang, CASE WHEN {in_test(0.2, 11, 'doc_id')} THEN 'test' ELSE 'train' "
         "END AS split FROM documents")


@query(f"SELECT doc_id, lang FROM ({SPLIT}) WHERE split = 'test'")
def split_select(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return with_split(rows, I.in_test_split(0.2, 11, F.col("doc_id"))).where(
        F.col("split") == "test").drop("split")


@query(SPLIT)
def hash_split(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return with_split(rows, I.in_test_split(0.2, 11, F.col("doc_id")))


@query(f"SELECT doc_id, {clean('text')} AS text FROM documents")
def clean_newlines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.clean_newlines(F.col("text")).alias("text"))


# The white lists of functions/text.py, spelt for SQL strings.
_KEEP = "[^ \\r\\nㄱ-ㅎㅏ-ㅣ가-힣a-zA-Z0-9~₩!@#$%^&*()_+|{}:\"<>?`\\-=\\\\\\[\\];'',./]"
_WORDS = "[^0-9a-zA-Zㄱ-ㅎㅏ-ㅣ가-힣]"
_WS = r"[\x09-\x0D\x1C-\x1F\x{85}\p{Z}]+"


@query("SELECT doc_id, "
       f"trim(regexp_replace(regexp_replace(lower(text), '{_KEEP}', ' ', 'g'), '{_WS}', ' ', 'g')) "
       "AS with_punctuation, "
       f"trim(regexp_replace(regexp_replace(lower(text), '{_WORDS}', ' ', 'g'), '{_WS}', ' ', 'g')) "
       "AS words_only FROM documents")
def clean_whitelist(spark, sf_dir):
    rows = use_all_cores(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return rows.select(
        "doc_id", X.clean_whitelist(F.col("text")).alias("with_punctuation"),
        X.clean_whitelist(F.col("text"), keep_punctuation=False).alias("words_only"))


@query("SELECT conv_id || '-' || turn AS label, conv_id AS article_id, CAST(turn AS INT) AS "
       "paragraph_id, TRY_CAST(conv_id AS BIGINT) AS role_article FROM conversations")
def split_passage_id(spark, sf_dir):
    label = I.passage_label(F.col("conv_id"), F.col("turn"))
    return (
        table(spark, sf_dir, "conversations")
        .select(label.alias("label"), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("role"))
                .alias("_odd"))
        .select("label", I.article_part(F.col("label")).alias("article_id"),
                I.paragraph_part(F.col("label")).alias("paragraph_id"),
                I.article_part(F.col("_odd")).alias("role_article"))
    )


@query(with_(DIALOGUES, "SELECT dialog_id, answer FROM dialogues"))
def first_answer(spark, sf_dir):
    answers = F.struct(F.array(F.col("answer"), F.col("question")).alias("text"),
                       F.array(F.lit(0), F.lit(0)).alias("answer_start"))
    return dialogues(spark, sf_dir).select(
        "dialog_id", answers.alias("answers")).select(
        "dialog_id", I.first_answer(F.col("answers")).alias("answer"))


@query(with_(ARTICLES, "SELECT article_id, '제목: ' || title || ' 글: ' AS title FROM articles"))
def decorate_title(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "article_id", X.decorate_title(F.col("title")).alias("title"))


@query(with_(DIALOGUES, f"SELECT dialog_id, array_to_string({sentence_list('answer')}, chr(10)) "
                        "AS lines FROM dialogues"))
def sentence_lines(spark, sf_dir):
    return dialogues(spark, sf_dir).select(
        "dialog_id", X.sentence_lines(F.col("answer")).alias("lines"))


def _share(k, n, p):
    return (f"(CASE WHEN {k} > 0 THEN {k} * ln({p}) ELSE 0.0 END + CASE WHEN {n} - {k} > 0 THEN ({n} - {k}) * ln(1 - {p}) "
            "ELSE 0.0 END)")


def _ratio(k, first, second):
    p, p1 = f"({second} / total)", f"({k} / {first})"
    p2 = f"(({second} - {k}) / greatest(total - {first}, 1.0))"
    return (f"round(2 * ({_share(k, first, p1)} + {_share(f'({second} - {k})', f'(total - {first})', p2)} - "
            f"{_share(k, first, p)} - {_share(f'({second} - {k})', f'(total - {first})', p)}), 6)")


_BARE = (r"lower(regexp_replace(regexp_replace({0}, '^[^\p{{L}}\p{{N}}]+', ''), '[^\p{{L}}\p{{N}}]+$', ''))")
_MODEL_SQL = with_({
    "listed": r"SELECT list_filter(string_split_regex(text, '[\t\n\x0B\f\r ]+'), lambda t: t <> '') AS t FROM documents",
    "pairs": f"SELECT {_BARE.format('t[i]')} AS word, ends_with(t[i], '.') AS dotted, coalesce({_BARE.format('t[i + 1]')}, '') "
             "AS next FROM (SELECT t, unnest(range(1, len(t) + 1)) AS i FROM listed)",
    "seen": "SELECT word, dotted, next, count(*) AS n FROM pairs GROUP BY ALL",
    "types": "SELECT word, sum(n) AS n, sum(CASE WHEN dotted THEN n ELSE 0 END) AS dots FROM seen WHERE word <> '' GROUP BY word",
    "whole": "SELECT CAST(sum(n) AS DOUBLE) AS total, least(greatest(sum(dots) / sum(n), 1e-12), 0.99) AS share FROM types",
    "sized": "SELECT *, length(word) - length(replace(word, '.', '')) AS inside, CAST(length(replace(word, '.', '')) AS DOUBLE) "
             "AS letters FROM types, whole WHERE dots >= 3",
    "short": f"SELECT word, round(2 * ({_share('dots', 'n', '0.99')} - {_share('dots', 'n', 'share')}) * exp(-letters) * "
             r"(inside + 1) * pow(letters, -CAST(n - dots AS DOUBLE)), 6) AS score FROM sized WHERE regexp_matches(word, '\p{L}') "
             "AND score >= 0.3",
    "ends": "SELECT word, next, sum(n) AS k FROM seen WHERE dotted AND word <> '' AND next <> '' GROUP BY ALL",
    "plain": "SELECT next AS word, CAST(sum(k) AS DOUBLE) AS k FROM ends WHERE word NOT IN (SELECT word FROM short) GROUP BY next",
    "begun": "SELECT CAST(sum(k) AS DOUBLE) AS b FROM plain",
    "starts": f"SELECT word, {_ratio('k', 'b', 'n')} AS score FROM (SELECT p.word, k, CAST(n AS DOUBLE) AS n, b, total FROM plain p "
              "JOIN types USING (word), begun, whole WHERE k >= 3 AND k * total > n * b)",
    "tied": f"SELECT word, next, {_ratio('k', 'f', 's')} AS score FROM (SELECT e.word, e.next, CAST(k AS DOUBLE) AS k, "
            "CAST(a.dots AS DOUBLE) AS f, CAST(c.n AS DOUBLE) AS s, total FROM ends e JOIN types a ON a.word = e.word JOIN types c "
            "ON c.word = e.next, whole WHERE k >= 3) WHERE k * total > s * f AND word IN (SELECT word FROM short)",
}, "SELECT 'abbreviation' AS kind, word, '' AS next, score FROM short UNION ALL SELECT 'starter', word, '', score FROM starts "
   "WHERE score >= 30.0 UNION ALL SELECT 'pair', word, next, score FROM tied WHERE score >= 7.88")


@query(_MODEL_SQL)
def sentence_model(spark, sf_dir):
    """Abbreviations, starters and pairs learned from all documents."""
    return sentences.sentence_model(table(spark, sf_dir, "documents"))


@query()
def sentence_lines_trained(spark, sf_dir):
    """Documents with one sentence per line, cut at the borders the learned model leaves."""
    docs = table(spark, sf_dir, "documents")
    cut = sentences.trained_sentences(docs, sentences.sentence_model(docs), "doc_id")
    return cut.select("doc_id", F.array_join("sentences", "\n").alias("lines"))


@query("SELECT doc_id, lang, CASE WHEN row_number() OVER (ORDER BY md5('17-' || doc_id), doc_id) <= round(count(*) OVER () * 0.15) "
       "THEN 'test' ELSE 'train' END AS split FROM documents")
def exact_split(spark, sf_dir):
    """Exactly 15 % of the documents, to the row, are test rows."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return splits.exact_split(rows, "doc_id", 0.15, 17)


_REFUSED = ("(CASE WHEN coalesce(question, '') = '' THEN ['no question'] ELSE [] END || CASE WHEN coalesce(answer, '') = '' "
            "THEN ['no answer'] ELSE [] END || CASE WHEN answer_start IS NULL THEN ['no place'] ELSE [] END || "
            "CASE WHEN length(question) > 200 THEN ['long question'] ELSE [] END)")


def _checked(spark, sf_dir):
    rules = {**qa.COMPLETE, "no place": F.col("answer_start").isNull(), "long question": F.length("question") > 200}
    return qa.quarantine(qa_rows(spark, sf_dir).drop("context"), rules)


@query(with_({**QA, "judged": f"SELECT qa_id, {_REFUSED} AS r FROM qa"},
             "SELECT qa_id, array_to_string(r, ',') AS reasons FROM judged WHERE len(r) > 0"))
def quarantined_qa(spark, sf_dir):
    """Refused question rows with their reasons, from the side table."""
    return _checked(spark, sf_dir)[1].select("qa_id", F.array_join("reasons", ",").alias("reasons"))


@query(with_({**QA, "judged": f"SELECT {_REFUSED} AS r FROM qa"},
             "SELECT 'accepted' AS reason, count(*) AS n FROM judged WHERE len(r) = 0 UNION ALL SELECT 'rows', count(*) FROM judged "
             + "".join(f"UNION ALL SELECT '{x}', count(*) FILTER (list_contains(r, '{x}')) FROM judged "
                       for x in ("no question", "no answer", "no place", "long question"))))
def observed_qa(spark, sf_dir):
    """Counts observed while the two tables were written."""
    counts = _checked(spark, sf_dir)[2]
    return spark.createDataFrame(sorted(counts.items()), "reason string, n bigint")


@query("SELECT doc_id, CASE WHEN doc_id <= 500 THEN 'wiki' ELSE 'other' END AS part "
       "FROM documents")
def source_threshold(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id")
    return (
        qa.below_threshold(rows, "doc_id", 500).withColumn("part", F.lit("wiki"))
        .unionByName(qa.above_threshold(rows, "doc_id", 500).withColumn("part", F.lit("other")))
    )


_ASKED = "CASE WHEN role = 'user' THEN text WHEN role = 'assistant' THEN '' END"


@query(f"SELECT conv_id, turn, {_ASKED} AS question FROM conversations "
       f"WHERE coalesce({_ASKED}, '') <> ''")
def has_question(spark, sf_dir):
    question = F.when(F.col("role") == "user", F.col("text")).when(
        F.col("role") == "assistant", F.lit(""))
    return qa.has_question(table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", question.alias("question")))


@query(with_(QA, "SELECT count(*) AS n_rows, count(*) FILTER (coalesce(question, '') = '') AS "
                 "n_no_question, count(*) FILTER (coalesce(answer, '') = '') AS n_no_answer, "
                 "count(*) FILTER (coalesce(question, '') <> '' AND coalesce(answer, '') <> '') "
                 "AS n_usable FROM qa"))
def qa_quality_report(spark, sf_dir):
    return qa.quality_report(qa_rows(spark, sf_dir))


@query(with_({**QA, "known": "SELECT title, text, min(article_id) AS article_id FROM articles "
                             "GROUP BY title, text"},
             "SELECT qa_id, known.article_id FROM qa LEFT JOIN known "
             "ON known.title = qa.title AND known.text = qa.context"))
def repair_article_id(spark, sf_dir):
    repaired = qa.repair_article_ids(
        qa_rows(spark, sf_dir).drop("article_id"), articles(spark, sf_dir))
    return repaired.select("qa_id", "article_id")


CHUNKED_QA = {
    **QA,
    "located": f"SELECT qa_id, article_id, title, question, answer, context AS text, "
               f"CASE WHEN answer_start >= 0 THEN length({canonical('context[:answer_start]')}) END "
               f"AS off FROM qa",
    **chunks("cut", "located", "qa_id, article_id, title, question, answer, off"),
    "hits": "SELECT qa_id, max(paragraph_id) AS hit FROM cut WHERE start <= off GROUP BY qa_id",
    "chunked_qa": "SELECT qa_id, article_id, paragraph_id, article_id || '-' || paragraph_id AS "
                  "passage_label, title, text, CASE WHEN paragraph_id = hit THEN question END AS "
                  "question, CASE WHEN paragraph_id = hit THEN answer END AS answer "
                  "FROM cut LEFT JOIN hits USING (qa_id)",
}


@query(with_(CHUNKED_QA, "SELECT * FROM chunked_qa"))
def chunk_qa(spark, sf_dir):
    return chunking.chunk_qa(qa_rows(spark, sf_dir))


@query(with_({**CHUNKED_QA, **{k: v for k, v in PASSAGES.items() if k != "articles"}},
             "SELECT c.qa_id, p.article_id AS passage_article_id, "
             "p.paragraph_id AS passage_paragraph_id FROM chunked_qa c LEFT JOIN passages p "
             "ON p.title = c.title AND p.text = c.text WHERE coalesce(c.question, '') <> ''"))
def assign_passage_id(spark, sf_dir):
    pairs = qa.has_question(chunking.chunk_qa(qa_rows(spark, sf_dir)))
    return qa.assign_passage_ids(pairs, passages(spark, sf_dir)).select(
        "qa_id", "passage_article_id", "passage_paragraph_id")


CANONICAL = {**ARTICLES,
             "canon": "SELECT article_id AS old_id, min(article_id) OVER "
                      "(PARTITION BY title, text) AS new_id FROM articles"}


@query(with_(CANONICAL, "SELECT old_id, new_id FROM canon WHERE old_id > new_id"))
def canonical_map(spark, sf_dir):
    return dedup.canonical_map(articles(spark, sf_dir), ["title", "text"], "article_id")


@query(with_(CANONICAL, "SELECT old_id AS qa_id, new_id AS article_id FROM canon"))
def remap_ids(spark, sf_dir):
    rows = articles(spark, sf_dir)
    removed = dedup.canonical_map(rows, ["title", "text"], "article_id")
    stale = rows.select(F.col("article_id").alias("qa_id"), "article_id")
    return dedup.remap_ids(stale, removed, "article_id", "qa_id").select("qa_id", "article_id")


@query(with_(ARTICLES, "SELECT title, text, min(article_id) AS first_id, max(article_id) AS "
                       "last_id, count(*) AS n_rows FROM articles GROUP BY title, text "
                       "HAVING count(DISTINCT article_id) > 1"))
def dup_groups(spark, sf_dir):
    return dedup.duplicate_groups(articles(spark, sf_dir), ["title", "text"], "article_id")


@query(with_(PASSAGES, "SELECT article_id, title, text FROM kept_articles"))
def dedup_articles(spark, sf_dir):
    return clean_articles(articles(spark, sf_dir))


@query(with_({**ARTICLES, **chunks("cut", "articles", "article_id, title")},
             "SELECT article_id, paragraph_id, title, start, text FROM cut"))
def chunk_passages(spark, sf_dir):
    return chunking.chunk_articles(wide_articles(spark, sf_dir))


@query(with_({**ARTICLES, **chunks("cut", "articles", "article_id, title"),
              "wrapped": "SELECT article_id, title, paragraph_id, start, unnest(CASE WHEN "
                         "length(text) <= 470 THEN [text] ELSE "
                         "regexp_extract_all(text, '(?s).{1,470}') END) AS text, "
                         "generate_subscripts(CASE WHEN length(text) <= 470 THEN [text] ELSE "
                         "regexp_extract_all(text, '(?s).{1,470}') END, 1) AS piece FROM cut"},
             "SELECT article_id, title, CAST(row_number() OVER (PARTITION BY article_id ORDER BY "
             "paragraph_id, piece) - 1 AS INT) AS paragraph_id, CAST(start + (piece - 1) * 470 AS "
             "INT) AS start, text FROM wrapped"))
def chunk_passages_wrapped(spark, sf_dir):
    return chunking.chunk_articles(wide_articles(spark, sf_dir), hard_wrap=True)


@query(with_(PASSAGES, "SELECT passage_id, article_id, paragraph_id, title, start, text "
                       "FROM passages"))
def dedup_passages(spark, sf_dir):
    return passages(spark, sf_dir)


@query(with_({**ARTICLES, **chunks("cut", "articles", "article_id, title")},
             "SELECT title, text, article_id, paragraph_id FROM cut QUALIFY row_number() OVER "
             "(PARTITION BY title, text ORDER BY article_id, paragraph_id) = 1"))
def first_occurrence(spark, sf_dir):
    cut = chunking.chunk_articles(wide_articles(spark, sf_dir))
    return dedup.keep_first(cut.drop("start"), ["title", "text"], ["article_id", "paragraph_id"])


@query(with_(PASSAGES, "SELECT article_id, count(*) AS n_passages, sum(length(text)) AS n_chars "
                       "FROM passages GROUP BY article_id"))
def article_fanout(spark, sf_dir):
    return passages(spark, sf_dir).groupBy("article_id").agg(
        F.count("*").alias("n_passages"), F.sum(F.length("text")).alias("n_chars"))


@query(with_({**CHUNKED_QA}, "SELECT qa_id, off AS \"offset\", hit AS paragraph_id FROM located "
                             "LEFT JOIN hits USING (qa_id)"))
def locate_answer_chunk(spark, sf_dir):
    offset = F.when(F.col("answer_start") >= 0, X.canonical_offset(
        F.col("context"), F.col("answer_start")))
    answers = qa_rows(spark, sf_dir).select("qa_id", "article_id", offset.alias("offset"))
    cut = chunking.chunk_articles(wide_articles(spark, sf_dir))
    return chunking.locate_answers(answers, cut).select("qa_id", "offset", "paragraph_id")


@query(with_({**CHUNKED_QA, **{k: v for k, v in PASSAGES.items() if k != "articles"}},
             "SELECT passage_id FROM passages p WHERE NOT EXISTS (SELECT 1 FROM chunked_qa c "
             "WHERE c.title = p.title AND c.text = p.text AND coalesce(c.question, '') <> '')"))
def generation_needed(spark, sf_dir):
    pairs = chunking.chunk_qa(qa_rows(spark, sf_dir))
    return qa.passages_without_question(passages(spark, sf_dir), pairs).select("passage_id")


@query(with_(VALIDATION, "SELECT dialog_id, question, answer FROM dialogues WHERE question NOT IN "
                         "(SELECT question FROM validation)"))
def train_split(spark, sf_dir):
    rows = dialogues(spark, sf_dir).select("dialog_id", "question", "answer")
    return qa.train_rows(rows, validation_questions(spark, sf_dir), "dialog_id")


@query(with_(VALIDATION, "SELECT dialog_id, question, answer FROM dialogues WHERE question IN "
                         "(SELECT question FROM validation)"))
def valid_split(spark, sf_dir):
    rows = dialogues(spark, sf_dir).select("dialog_id", "question", "answer")
    return qa.validation_rows(rows, validation_questions(spark, sf_dir), "dialog_id")


@query(with_({**QA, **DIALOGUES},
             "SELECT 'article' AS origin, qa_id, title, question, answer FROM qa UNION ALL "
             "SELECT 'dialogue', dialog_id, 'dialogue', question, answer FROM dialogues"))
def union_qa(spark, sf_dir):
    written = qa_rows(spark, sf_dir).select(
        F.lit("article").alias("origin"), "qa_id", "title", "question", "answer")
    spoken = dialogues(spark, sf_dir).select(
        F.lit("dialogue").alias("origin"), F.col("dialog_id").alias("qa_id"),
        F.lit("dialogue").alias("title"), "question", "answer")
    return written.unionByName(spoken)


@query(with_(PASSAGES, "SELECT article_id || '-' || paragraph_id AS label, title, text "
                       "FROM passages WHERE article_id <= 56736"))
def moco_subset(spark, sf_dir):
    low = qa.below_threshold(passages(spark, sf_dir), "article_id")
    return low.orderBy("article_id", "paragraph_id").select(
        I.passage_label(F.col("article_id"), F.col("paragraph_id")).alias("label"), "title", "text")


@query("SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 200")
def head_n(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "text").orderBy(
        "doc_id").limit(200)
