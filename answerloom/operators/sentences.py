"""Sentence borders learned from the texts themselves, without labels.

A period behind a word may end a sentence or belong to an abbreviation.  Three tables of log-likelihood ratios
(Dunning 1993; Kiss and Strunk 2006) are aggregates over all texts:

* abbreviations: words that nearly always come with a period, short ones and ones with inner periods first;
* starters: words that follow a period behind an ordinary word more often than they occur at all;
* pairs: words that follow a certain word with a period more often than they occur at all.

A period ends no sentence behind an abbreviation, unless a starter follows, and none inside a pair.
``!`` and ``?`` always end one.  The tables hold words, not places, so they are far smaller than
the texts; borders look them up while the texts stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.functions.text import BREAK, clean_newlines
from answerloom.operators.skew import computed_once, lookup
from answerloom.operators.stored import written_once

# Thresholds of the published method.
LEAST_ABBREVIATION, LEAST_STARTER, LEAST_PAIR = 0.3, 30.0, 7.88
SURE = 0.99
# Letters, digits and inner periods, hyphens and apostrophes; what stands around them is cut off.
EDGE = r"[^\p{L}\p{N}]+"


def _tokens(text: Column) -> Column:
    """Words between white space, none empty."""
    return F.filter(F.split(text, BREAK, -1), lambda t: t != "")


def _bare(token: Column) -> Column:
    """A token without its edges, in lower case: the word without the period that may end it."""
    return F.lower(F.regexp_replace(F.regexp_replace(token, "^" + EDGE, ""), EDGE + "$", ""))


def _outer_word(text: Column, side: int) -> Column:
    """What stands before the first (1) or behind the last (-1) white space of ``text``."""
    for space in " \t\n\x0B\f\r":
        text = F.substring_index(text, space, side)
    return text


def neighbours(texts: DataFrame, text_column: str) -> DataFrame:
    """word, dotted, next, n: how often a word occurs, and with a period which word stands behind it.

    Words behind one without a period say nothing to the model; ``next`` is empty there.  Tokens are counted as they
    stand and only distinct ones are freed of their edges.
    """
    listed = computed_once(texts.select(F.col(text_column).alias("text")), "t", _tokens(F.col("text")))
    follow = F.concat(F.slice("t", 2, F.size("t")), F.array(F.lit("")))
    pairs = F.arrays_zip(F.col("t").alias("token"), follow.alias("follow"))
    dotted = F.endswith("token", F.lit("."))
    return (
        listed.where(F.size("t") > 0).select(F.explode(pairs).alias("p")).select("p.token", "p.follow")
        .groupBy("token", F.when(dotted, F.col("follow")).otherwise("").alias("follow")).agg(F.count("*").alias("n"))
        .groupBy(_bare(F.col("token")).alias("word"), dotted.alias("dotted"), _bare(F.col("follow")).alias("next"))
        .agg(F.sum("n").alias("n"))
    )


def _log_share(k: Column, n: Column, p: Column) -> Column:
    """Log likelihood of ``k`` of ``n`` at share ``p``; nothing of nothing is certain."""
    hit = F.when(k > 0, k * F.log(p)).otherwise(0.0)
    return hit + F.when(n - k > 0, (n - k) * F.log(1 - p)).otherwise(0.0)


def _dunning(both: Column, first: Column, second: Column, total: Column) -> Column:
    """How much likelier it is that the second depends on the first than that it does not."""
    p, p1, p2 = second / total, both / first, (second - both) / F.greatest(total - first, F.lit(1.0))
    rest = second - both
    return 2 * (_log_share(both, first, p1) + _log_share(rest, total - first, p2)
                - _log_share(both, first, p) - _log_share(rest, total - first, p))


def sentence_model(texts: DataFrame, text_column: str = "text", least_count: int = 3) -> DataFrame:
    """kind (abbreviation, starter, pair), word, next, score.

    Words must occur ``least_count`` times in their role.  Null texts say nothing; an empty table gives no rows.
    """
    seen = written_once(neighbours(texts, text_column))
    words = written_once(seen.where("word <> ''").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("dotted"), F.col("n")).otherwise(0)).alias("dots")))
    whole = words.agg(F.sum("n").alias("n"), F.sum("dots").alias("dots")).first()
    total, dots = float(whole["n"] or 0), float(whole["dots"] or 0)
    none = F.lit("")
    share = F.lit(min(max(dots / total, 1e-12), SURE) if total else SURE)
    ratio = 2 * (_log_share(F.col("dots"), F.col("n"), F.lit(SURE)) - _log_share(F.col("dots"), F.col("n"), share))
    inner = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    letters = (F.length("word") - inner).cast("double")
    # Long words and words seen without a period are ever less likely abbreviations.
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -(F.col("n") - F.col("dots")).cast("double"))
    short = words.where((F.col("dots") >= least_count) & F.col("word").rlike(r"\p{L}")).select(
        F.lit("abbreviation").alias("kind"), "word", none.alias("next"), F.round(score, 6).alias("score")).where(
        F.col("score") >= LEAST_ABBREVIATION)
    short = written_once(short)
    ends = seen.where("dotted and word <> '' and next <> ''")
    plain = lookup(ends, short.select("word"), ["word"], "left_anti", F.col("next")).groupBy("next").agg(F.sum("n").alias("both"))
    begun = plain.agg(F.sum("both").alias("n")).first()["n"] or 0
    known = words.select(F.col("word").alias("next"), F.col("n").alias("second"))
    starters = lookup(plain.where(F.col("both") >= least_count), known, ["next"], "inner", F.col("next")).where(
        F.col("both") * total > F.col("second").cast("double") * begun).select(
        F.lit("starter").alias("kind"), F.col("next").alias("word"), none.alias("next"),
        F.round(_dunning(F.col("both"), F.lit(float(begun)), F.col("second"), F.lit(total)), 6).alias("score")).where(
        F.col("score") >= LEAST_STARTER)
    dotted = words.where("dots > 0").select("word", F.col("dots").alias("first"))
    pairs = ends.groupBy("word", "next").agg(F.sum("n").alias("both")).where(F.col("both") >= least_count)
    pairs = lookup(lookup(pairs, dotted, ["word"], "inner", F.col("next")), known, ["next"], "inner", F.col("word"))
    tied = pairs.where(F.col("both") * total > F.col("second").cast("double") * F.col("first")).select(
        F.lit("pair").alias("kind"), "word", "next",
        F.round(_dunning(F.col("both"), F.col("first"), F.col("second"), F.lit(total)), 6).alias("score")).where(
        F.col("score") >= LEAST_PAIR)
    # Pairs tell something about abbreviations only: behind an ordinary word a starter looks the same.
    tied = lookup(tied, short.select("word"), ["word"], "left_semi", F.col("next"))
    return short.unionByName(starters).unionByName(tied)


def trained_sentences(texts: DataFrame, model: DataFrame, id_column: str, text_column: str = "text") -> DataFrame:
    """(id, sentences): texts cut at the borders that the model leaves.

    Candidates are the borders of the fixed rule.  Every row counts by itself, ids may repeat or be missing.
    A null text has no sentences, an empty one is one empty sentence.
    """
    model = written_once(model)
    rows = written_once(texts.select(
        F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"),
        F.split(clean_newlines(F.col(text_column)), "(?<=[.!?])" + BREAK, -1).alias("parts")))
    last, first = _outer_word(F.get("parts", F.col("at") - 1), -1), _outer_word(F.col("part"), 1)
    parts = rows.select("row", "parts", F.posexplode("parts").alias("at", "part")).select(
        "row", "at", "part", F.when(F.col("at") > 0, last).alias("last"), _bare(first).alias("next"))
    # Most borders need no look at the model: only those behind a period and a known abbreviation do.
    asked = parts.where(F.endswith("last", F.lit("."))).select("row", "at", _bare(F.col("last")).alias("word"), "next")
    short = model.where("kind = 'abbreviation'").select("word")
    behind = lookup(asked, short, ["word"], "left_semi", F.col("row"))
    starters = model.where("kind = 'starter'").select(F.col("word").alias("next"), F.lit(True).alias("starts"))
    pairs = model.where("kind = 'pair'").select("word", "next", F.lit(True).alias("tied"))
    judged = lookup(lookup(behind, starters, ["next"], "left", F.col("row")), pairs, ["word", "next"], "left", F.col("row"))
    joined = judged.where(F.col("tied").isNotNull() | F.col("starts").isNull()).select("row", "at")
    joined = written_once(joined)
    touched = joined.select("row").distinct()
    left = lookup(rows, touched, ["row"], "left_anti", F.col("row")).select("id", F.col("parts").alias("sentences"))
    # Only texts that lose a border move: their parts are numbered by the borders that stay, and put together.
    moved = written_once(lookup(rows, touched, ["row"], "left_semi", F.col("row")))
    pieces = lookup(moved.select("row", F.posexplode("parts").alias("at", "part")), joined.withColumn("soft", F.lit(0)),
                    ["row", "at"], "left", F.col("row"))
    number = F.sum(F.coalesce("soft", F.lit(1))).over(Window.partitionBy("row").orderBy("at"))
    whole = (
        pieces.withColumn("number", number)
        .groupBy("row", "number").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("p"))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("number", F.array_join("p.part", " ").alias("s")))).alias("s"))
    )
    glued = moved.select("id", "row").join(whole, "row").select("id", F.col("s.s").alias("sentences"))
    return left.unionByName(glued).withColumnRenamed("id", id_column)
