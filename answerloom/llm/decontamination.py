"""Benchmark passages in training texts, in DataFrame operations only.

The benchmark's items are cut into windows of ten words.  The distinct windows are broadcast by
their hashes while they are at most a million of at most 256 MB; every document's words are hashed
once, the hashes of all its windows stream past the broadcast set where the document was
scanned, and a hit counts only if the words themselves are equal.  The words stay in the task:
only a document's hits leave it, packed into one row.

More windows than that meet the documents' window hashes in a join that deals out frequent
windows; rows with a candidate then fetch their words by row.

A window is ten words of an item; an item of fewer words is one window.  So there are at most ten
lengths, and only those that occur are looked for.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.operators.skew import computed_once, lookup, skew_join
from answerloom.operators.stored import written_once

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
BROADCAST_WINDOWS, BROADCAST_BYTES = 1_000_000, 256 << 20
# Stands at the end of every document's hashes and in the broadcast set, so that
# a document without hits gives a row as well.
END_MARK = 0


def words(text: Column) -> Column:
    """Runs of digits, letters and characters outside ASCII, A-Z in lower case; none for null.

    ``lower`` does the same as the translation where every character is one byte.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    small = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(small, GAP), "")


def _starts(n_words: Column, length: Column | int) -> Column:
    """1 .. last start of a window; the caller sees to it that there is one."""
    return F.sequence(F.lit(1), n_words - length + 1)


def _hash(word_hashes: Column) -> Column:
    return F.xxhash64(word_hashes)


def item_windows(items: DataFrame, id_column: str, text_column: str, width: int = WINDOW) -> DataFrame:
    """item_id (string), n, text: the distinct windows of every item with words."""
    listed = computed_once(items.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text")),
                           "words", words(F.col("text")))
    n = F.least(F.size("words"), F.lit(width))
    return (
        listed.where(F.size("words") > 0)
        .select(F.coalesce("id", F.lit("")).alias("item_id"), n.alias("n"), "words",
                F.explode(_starts(F.size("words"), n)).alias("at"))
        .select("item_id", "n", F.array_join(F.slice("words", F.col("at"), F.col("n")), " ").alias("text"))
        .distinct()
    )


def _hashed(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """row, doc_id, words, marks: hashes of all windows, length after length, and the end mark."""
    worded = computed_once(rows, "words", words(F.col("text"))).select("row", "doc_id", "words")
    coded = computed_once(worded, "codes", F.transform("words", lambda w: F.xxhash64(w)))
    size = F.size("codes")
    none = F.expr("cast(array() as array<bigint>)")

    def of_length(n: int) -> Column:
        return F.when(size >= n, F.transform(_starts(size, n), lambda i: _hash(F.slice("codes", i, n)))).otherwise(none)

    parts = [of_length(n) for n in lengths]
    marked = computed_once(coded, "marks", F.concat(*parts, F.array(F.lit(END_MARK).cast("bigint"))))
    return marked.select("row", "doc_id", "words", "marks")


def _window_at(index: Column, n: Column, size: Column, lengths: list[int]) -> Column:
    """Where in the text window ``index`` of the hashes begins, if its length is ``n``."""
    at, before = F.lit(None).cast("int"), F.lit(0)
    for length in lengths:
        at = F.when(n == length, index - before).otherwise(at)
        before = before + F.greatest(size - length + 1, F.lit(0))
    return at


def hits(rows: DataFrame, items: DataFrame, width: int = WINDOW, item_column: str = "item_id",
         item_text_column: str = "text", broadcast_windows: int = BROADCAST_WINDOWS
         ) -> tuple[DataFrame, DataFrame]:
    """What is found in each of ``rows`` (row, doc_id, text), and the items of every window.

    The first table has row, doc_id, n_words, spans (start * 16 + words, sorted, from 0) and windows
    (window numbers, sorted), the second window and item_id.
    """
    listed = written_once(item_windows(items, item_column, item_text_column, width))
    known = written_once(
        listed.select("n", "text").distinct()
        .select(F.monotonically_increasing_id().alias("window"), "n", F.col("text").alias("wanted"),
                _hash(F.transform(F.split("text", " "), lambda w: F.xxhash64(w))).alias("mark")))
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())
    ends = rows.sparkSession.range(1).select(
        F.lit(-1).cast("bigint").alias("window"), F.lit(0).alias("n"), F.lit("").alias("wanted"),
        F.lit(END_MARK).cast("bigint").alias("mark"))
    marks = _hashed(rows, lengths)
    wanted = known.select("window", "n", "wanted", "mark").unionByName(ends)
    held = known.agg(F.count("*").alias("n"), F.sum(F.octet_length("wanted")).alias("bytes")).first()
    if held["n"] <= broadcast_windows and (held["bytes"] or 0) <= BROADCAST_BYTES:
        met = marks.select("row", "doc_id", "words", F.posexplode("marks").alias("index", "mark")).join(
            F.broadcast(wanted), "mark")
    else:
        stored = written_once(marks)
        candidates = skew_join(stored.select("row", F.posexplode("marks").alias("index", "mark")), wanted, ["mark"],
                               "inner", F.col("row"))
        met = stored.select("row", "doc_id", "words").join(candidates, "row")
    at = _window_at(F.col("index"), F.col("n"), F.size("words"), lengths)
    same = F.array_join(F.slice("words", F.col("at") + 1, F.col("n")), " ") == F.col("wanted")
    real = F.col("window") >= 0
    # The words end here: an aggregate that reads them would sort them with its rows.
    hit = computed_once(
        met.withColumn("at", at).where(~real | ((F.col("at") >= 0) & same)), "hit",
        F.struct(F.size("words").alias("n_words"), F.when(real, F.col("at").cast("bigint") * 16 + F.col("n")).alias("span"),
                 F.when(real, F.col("window")).alias("window"))).select("row", "doc_id", "hit")
    found = hit.groupBy("row", "doc_id").agg(
        F.max("hit.n_words").alias("n_words"), F.array_sort(F.collect_set("hit.span")).alias("spans"),
        F.array_sort(F.collect_set("hit.window")).alias("windows"))
    return found, listed.join(known.select("window", "n", F.col("wanted").alias("text")), ["n", "text"]).select(
        "window", "item_id")


def _covered(spans: Column) -> Column:
    """Words inside any of the sorted spans, overlaps counted once."""
    def step(done: Column, span: Column) -> Column:
        start = F.shiftright(span, 4)
        end = start + span.bitwiseAND(15)
        return F.struct(F.greatest(done["end"], end).alias("end"),
                        (done["n"] + F.greatest(end - F.greatest(done["end"], start), F.lit(0))).alias("n"))

    zero = F.lit(0).cast("bigint")
    return F.aggregate(spans, F.struct(zero.alias("end"), zero.alias("n")), step, lambda done: done["n"])


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, id_column: str = "doc_id",
                  text_column: str = "text", **parameters) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts words inside any occurrence of an item's window, ``n_items`` the items with such
    windows; the digest is over their ids as strings, sorted, comma-joined.  Null and blank
    texts have no words.  Every row is judged by itself, also when rows repeat an id or have
    none.  Items that repeat an id are one item, items without an id are one with an
    empty id, items without words are never found.  No documents give no rows.

    Documents with the same windows share one digest, so a passage that very many
    documents hold is resolved to items once.
    """
    if width > 15:
        raise ValueError("windows of at most 15 words")
    found, listed = hits(_rows(docs, id_column, text_column), items, width, **parameters)
    # A row holds its hits only, so this table is far smaller than the texts.
    found = written_once(found.withColumn("same", F.when(F.size("windows") > 0, F.sha2(F.array_join(
        F.transform("windows", lambda w: w.cast("string")), ","), 256))))
    sets = found.where("same is not null").groupBy("same").agg(F.first("windows").alias("windows")).select(
        "same", F.explode("windows").alias("window"))
    of_set = lookup(sets, listed, ["window"], "inner", F.col("same")).groupBy("same").agg(
        F.array_sort(F.collect_set("item_id")).alias("items")).select(
        "same", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return lookup(found, of_set, ["same"], "left", F.col("row")).select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), _covered(F.col("spans")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame, whole: bool = False, width: int = WINDOW,
                   text_column: str = "text", **parameters) -> DataFrame:
    """``docs`` without the benchmark's passages, all columns kept.

    By default the hit words are cut out, each with the separators in front of it; with
    ``whole`` documents with a hit are dropped.  Rows without hits pass through as they are.  The
    rows are stored once with a key of their own, so ids play no part.
    """
    keyed = written_once(docs.select(F.struct("*").alias("packed"), F.monotonically_increasing_id().alias("row")))
    texts = keyed.select("row", F.lit(None).cast("bigint").alias("doc_id"),
                         F.col("packed").getField(text_column).alias("text"))
    found = hits(texts, items, width, **parameters)[0].where(F.size("spans") > 0).select("row", "spans")
    if whole:
        return lookup(keyed, found.select("row"), ["row"], "left_anti", F.col("row")).select("packed.*")
    text = F.col("packed").getField(text_column)
    # A word with the separators before it; what follows the last word stays.
    tokens = F.regexp_extract_all(text, F.lit(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
                                              r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    tail = F.regexp_extract(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*$", 0)

    def gap(done: Column, span: Column) -> Column:
        start = F.shiftright(span, 4).cast("int")
        end = start + span.bitwiseAND(15).cast("int")
        kept = F.when(start > done["end"], F.concat(done["kept"], F.array(F.struct(
            done["end"].alias("a"), start.alias("b"))))).otherwise(done["kept"])
        return F.struct(F.greatest(done["end"], end).alias("end"), kept.alias("kept"))

    none = F.expr("cast(array() as array<struct<a:int,b:int>>)")
    gaps = F.aggregate("spans", F.struct(F.lit(0).alias("end"), none.alias("kept")), gap, lambda done: F.concat(
        done["kept"], F.array(F.struct(done["end"].alias("a"), F.size("tokens").alias("b")))))
    pieces = F.flatten(F.transform(F.col("gaps"), lambda g: F.slice("tokens", g["a"] + 1, g["b"] - g["a"])))
    cut = keyed.join(found, "row")
    cut = computed_once(cut, "tokens", tokens)
    cut = computed_once(cut, "gaps", gaps).select(
        F.col("packed").withField(text_column, F.concat(F.array_join(pieces, ""), tail)).alias("packed"))
    clean = lookup(keyed, found.select("row"), ["row"], "left_anti", F.col("row")).select("packed")
    return clean.unionByName(cut).select("packed.*")
