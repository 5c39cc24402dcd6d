"""BM25 from a stored inverted index.

The index has one row for every term and slice of the passages: passage ids, term frequencies and passage lengths as
lists, with the largest frequency and the least length as bounds.  The empty word stands for whole passages: its
lists have all of a slice, with their lengths as frequencies.  A slice holds a bounded number
of passages and is counted in one task, so the lists of a frequent term are cut into as many parts as there are slices.  Files
are partitioned by a bucket of the term: a search reads only the buckets of the asked words.
Appending writes new slices; frequencies of terms, passages and words are summed at search time, so no
old file changes.

A search deals the asked lists by slice.  For each question a task adds up words from the largest bound
down and keeps the k-th best sum so far as a bar: once the words left cannot lift a new passage
over the bar, only passages begun before are completed, and when none of those can reach it
either, the remaining lists are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.text import words
from answerloom.operators.scoring import SCORE_DIGITS, TopK, rank_top
from answerloom.operators.skew import fits, skew_join
from answerloom.operators.stored import shared_folder, written_once

SLICE_PASSAGES, BUCKETS, FILE_SLICES = 16_384, 64, 64
BROADCAST_TERMS = 500_000
# Sums of rounded products may differ from the bound by this much; bars give way by it.
SLACK = 1e-6

_LISTS = ("slice bigint, term string, passage_ids array<bigint>, counts array<int>, lengths array<int>, "
          "most int, shortest int, n int, bucket int")
_SUMS = "slices bigint, passages bigint, words bigint"


def _bucket(term):
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 4), 16, 10).cast("int"), F.lit(BUCKETS))


def write_postings(passages: DataFrame, path: str, slice_passages: int = SLICE_PASSAGES) -> None:
    """A new index of ``passages`` (passage_id, text) at ``path``."""
    _write(passages, path, "overwrite", 0, slice_passages)


def append_postings(passages: DataFrame, path: str, slice_passages: int = SLICE_PASSAGES) -> None:
    """Further passages, as slices of their own; ids must be new."""
    spark = passages.sparkSession
    known = spark.read.schema(_SUMS).parquet(f"{path}/sums").agg(F.sum("slices").alias("n")).first()["n"] or 0
    _write(passages, path, "append", known, slice_passages)


def _slice_lists(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The lists of one slice: a row for every word, and one of the empty word with all passages and their lengths."""
    table = table.sort_by("passage_id")
    held = table["words"].combine_chunks()
    ids, lengths = table["passage_id"].to_numpy(), held.value_lengths().to_numpy()
    words_ = held.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(ids)), lengths)
    cell, counts = np.unique(words_.indices.to_numpy().astype(np.int64) * len(ids) + row, return_counts=True)
    term, row = np.divmod(cell, len(ids))
    # The empty word stands behind all others.
    none = len(words_.dictionary)
    term, row = np.append(term, np.full(len(ids), none)), np.append(row, np.arange(len(ids)))
    counts, lengths = np.append(counts, lengths).astype(np.int32), lengths[row].astype(np.int32)
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    ends = pa.array(np.append(starts, len(term)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(values)) for values in (ids[row], counts, lengths)]
    bounds = [pa.array(x) for x in (np.maximum.reduceat(counts, starts), np.minimum.reduceat(lengths, starts),
                                    np.diff(ends.to_numpy()))]
    terms = pa.concat_arrays([words_.dictionary, pa.array([""])])
    return pa.table([pa.array(np.full(len(starts), key[0].as_py())), terms, *lists, *bounds],
                    [part.split()[0] for part in _LISTS.split(", ")][:-1])


def _write(passages: DataFrame, path: str, mode: str, first_slice: int, slice_passages: int) -> None:
    spark, rows = passages.sparkSession, passages.select("passage_id", "text")
    slices = max(1, -(-rows.count() // slice_passages))
    # Texts move once, to the task of their slice; they are sorted before they are cut into words.
    dealt = rows.withColumn("slice", F.lit(first_slice).cast("bigint") + F.pmod(F.xxhash64("passage_id"), F.lit(slices)))
    split = dealt.repartition("slice").sortWithinPartitions("slice").select(
        "slice", "passage_id", words(F.coalesce("text", F.lit(""))).alias("words"))
    lists = split.groupBy("slice").applyInArrow(_slice_lists, _LISTS.removesuffix(", bucket int")).withColumn(
        "bucket", _bucket(F.col("term")))
    # A file has the lists of FILE_SLICES slices, so their number and size follow the passages, not the tasks.
    lists.repartition("bucket", F.floor(F.col("slice") / FILE_SLICES)).sortWithinPartitions("bucket", "term").write.mode(
        mode).partitionBy("bucket").parquet(f"{path}/lists")
    whole = spark.read.schema(_LISTS).parquet(f"{path}/lists").where(
        (F.col("bucket") == _bucket(F.lit(""))) & (F.col("term") == "") & (F.col("slice") >= first_slice))
    words_ = F.aggregate("counts", F.lit(0).cast("bigint"), lambda total, n: total + n)
    whole.agg(F.lit(slices).cast("bigint").alias("slices"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("passages"),
              F.coalesce(F.sum(words_), F.lit(0)).cast("bigint").alias("words")).write.mode(mode).parquet(f"{path}/sums")


def asked_lists(terms: DataFrame, spark: SparkSession, path: str, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """The stored lists of ``terms`` (term, distinct); only their buckets, at most 64, are listed and read."""
    buckets = [r["bucket"] for r in terms.select(_bucket(F.col("term")).alias("bucket")).distinct().collect()]
    lists = spark.read.schema(_LISTS).parquet(f"{path}/lists").where(F.col("bucket").isin(buckets))
    if fits(terms, broadcast_terms):
        return lists.join(F.broadcast(terms), "term", "left_semi")
    return skew_join(lists, terms, ["term"], "left_semi", F.col("slice"))


def best_of_slice(terms: list[tuple[float, np.ndarray, np.ndarray]], n: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of passages that may be among a question's ``k`` best, and how many lists were read.

    ``terms``: largest gain, places (in a slice of ``n`` passages) and gains of every asked word.
    """
    terms = sorted(terms, key=lambda t: -t[0])
    rest = np.cumsum([0.0, *(t[0] for t in reversed(terms))])[::-1]
    score, begun = np.zeros(n), np.zeros(n, bool)
    bar, read = -np.inf, 0
    for no, (_, places, gains) in enumerate(terms):
        if bar > -np.inf and rest[no] < bar - SLACK:
            # New passages cannot reach the bar any more; begun ones only with what is left.
            begun &= score + rest[no] >= bar - SLACK
            if not begun.any():
                break
            keep = begun[places]
            places, gains = places[keep], gains[keep]
        else:
            begun[places] = True
        read += 1
        score[places] += gains
        # Sums only grow: the k best of now are among those that reach the last bar.
        open_scores = score[begun & (score >= bar)]
        if len(open_scores) >= k:
            bar = max(bar, np.partition(open_scores, len(open_scores) - k)[len(open_scores) - k])
    at = np.flatnonzero(begun)
    at = at[score[at] >= bar - SLACK] if bar > -np.inf else at
    return at, score[at], read


def _search_slices(weights: pa.Table, spark: SparkSession, mean: float, k: int, k1: float, b: float):
    """A function that runs on executors: lists sorted by slice in, partial results out."""
    weights = weights.sort_by("question_id")
    asked: dict[int, list[tuple[str, float]]] = {}
    for q, t, w in zip(*(weights[c].to_pylist() for c in ("question_id", "term", "weight"))):
        asked.setdefault(q, []).append((t, w))
    shared = spark.sparkContext.broadcast(asked)

    def answers(lists: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids = np.unique(np.concatenate([x[0] for x in lists.values()]))
        ready = {}
        for term, (own, counts, lengths) in lists.items():
            gains = counts * (k1 + 1) / (counts + k1 * (1 - b + b * lengths / mean))
            ready[term] = (gains.max(), np.searchsorted(ids, own), gains)
        out = [[], [], []]
        for question, terms in shared.value.items():
            held = [(w * ready[t][0], ready[t][1], w * ready[t][2]) for t, w in terms if t in ready]
            if not held:
                continue
            at, score, _ = best_of_slice(held, len(ids), k)
            score = np.round(score, SCORE_DIGITS)
            best = np.lexsort((ids[at], -score))[:k]
            for column, values in zip(out, (np.full(len(best), question), ids[at[best]], score[best])):
                column.append(values)
        columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
            ["question_id", "passage_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, lists = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(0)[i].as_py() != current:
                    if lists:
                        yield answers(lists)
                    current, lists = batch.column(0)[i].as_py(), {}
                lists[batch.column(1)[i].as_py()] = tuple(
                    batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (2, 3, 4))
        if lists:
            yield answers(lists)

    return run


def search_postings(questions: DataFrame, spark: SparkSession, path: str, k: int, k1: float = 1.2, b: float = 0.75,
                    broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """Top ``k`` passages per question (question_id, text) from the index at ``path``: the rows of ``bm25_top``.

    Question words are broadcast with their weights.  More than ``broadcast_terms`` of them are dealt into blocks
    of whole questions that follow one another; each adds its partial results to a stored table.
    """
    asked = written_once(
        questions.select("question_id", F.explode(words(F.col("text"))).alias("term"))
        .groupBy("question_id", "term").agg(F.count("*").alias("qtf")))
    lists = written_once(asked_lists(asked.select("term").distinct(), spark, path, broadcast_terms))
    sums = spark.read.schema(_SUMS).parquet(f"{path}/sums").agg(
        F.sum("passages").alias("n"), F.sum("words").alias("words")).first()
    n, mean = sums["n"] or 0, (sums["words"] or 0) / max(1, sums["n"] or 0)
    counts = lists.groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = written_once(asked.join(counts, "term").select("term", "question_id", (F.col("qtf") * idf).alias("weight")))
    by_slice = lists.select("slice", "term", "passage_ids", "counts", "lengths").repartition("slice").sortWithinPartitions("slice")
    blocks = 1 if fits(weights, broadcast_terms) else -(-weights.count() // max(1, broadcast_terms))
    block = F.pmod(F.xxhash64("question_id"), F.lit(blocks))
    if blocks == 1:
        run = _search_slices(weights.toArrow(), spark, mean, k, k1, b)
        return rank_top(by_slice.mapInArrow(run, TopK.schema), k)
    partial = f"{shared_folder(spark)}/partial-{path.rsplit('/', 1)[-1]}-{k}"
    for i in range(blocks):
        run = _search_slices(weights.where(block == i).toArrow(), spark, mean, k, k1, b)
        by_slice.mapInArrow(run, TopK.schema).write.mode("overwrite" if i == 0 else "append").parquet(partial)
    return rank_top(spark.read.schema(TopK.schema).parquet(partial), k)
