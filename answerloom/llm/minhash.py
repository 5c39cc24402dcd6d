"""Near-duplicate documents by min-max hashing.

Every document's set of word shingles is hashed by P permutations of the 64-bit
numbers; each permutation gives two signature entries, its minimum and its
maximum, so half as many hash evaluations serve a signature of 2 P entries.  An
entry of two sets agrees with probability J, their similarity.  Entries are cut
into bands; sets that agree in a whole band become candidates, and every
candidate pair is confirmed on the full sets.

With 60 permutations, 24 bands of 5 entries miss a pair of similarity 0.85 with
probability (1 - 0.85^5)^24 = 8e-7, and 30 bands of 4 one of 0.80 with 1.4e-7; more similar
pairs less often.  ``limits`` derives the bands and the shares of sketches from the similarity.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.components import components
from answerloom.llm.words import WordHashes, mixed, shingle_hashes, words_of
from answerloom.operators.skew import lookup
from answerloom.operators.stored import written_once

PERMUTATIONS, MOST_BANDS = 60, 32
WIDTH, SHARE = 5, 85
# Before texts meet, sketches of one byte an entry do: 120 entries of the signature, then 512
# of further permutations.  Bands and either sketch miss a pair at the threshold with probability
# MISSED at most.
WIDE, MISSED = 256, 1e-6
BLOCK = 1000
CHUNK = 1 << 19


@dataclass(frozen=True)
class Limits:
    """What follows from the least similarity, in per cent."""

    share: int
    rows: int  # entries of a band
    agree: int  # least number of agreeing entries of the sketch
    wide_agree: int  # the same of the wide sketch


def _least(entries: int, similarity: float) -> int:
    """The largest number that entries agree in less often than MISSED."""
    below, k = 0.0, 0
    while k < entries:
        below += math.comb(entries, k) * similarity ** k * (1 - similarity) ** (entries - k)
        if below > MISSED:
            break
        k += 1
    return k


def limits(share: int) -> Limits:
    """The longest bands that miss no more than MISSED; less similar pairs than bands can find are refused."""
    entries, similarity = 2 * PERMUTATIONS, share / 100
    fit = [r for r in range(1, entries + 1) if entries % r == 0 and entries // r <= MOST_BANDS
           and (1 - similarity ** r) ** (entries // r) <= MISSED]
    if not fit or share > 100:
        raise ValueError(f"no bands for a similarity of {share} %")
    return Limits(share, max(fit), _least(entries, similarity), _least(2 * WIDE, similarity))

_generator = np.random.Generator(np.random.PCG64(20))
_ODD = _generator.integers(0, 1 << 63, PERMUTATIONS + WIDE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _generator.integers(0, 1 << 63, PERMUTATIONS + WIDE, dtype=np.uint64)


def min_max(flat: np.ndarray, starts: np.ndarray, first: int = 0, count: int = PERMUTATIONS) -> np.ndarray:
    """Signatures (sets x 2 P) of the sets that begin at ``starts`` in ``flat``."""
    out = np.empty((len(starts), 2 * count), np.uint64)
    with np.errstate(over="ignore"):
        for p, own in enumerate(range(first, first + count)):
            image = flat * _ODD[own] + _ADD[own]
            out[:, 2 * p] = np.minimum.reduceat(image, starts)
            out[:, 2 * p + 1] = np.maximum.reduceat(image, starts)
    return out


def band_hashes(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` entries; its low five bits are the band's number."""
    with np.errstate(over="ignore"):
        bands = signatures.reshape(len(signatures), -1, rows)
        count = bands.shape[1]
        key = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), bands.shape[:2])
        for r in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, r])
    return key & ~np.uint64(31) | np.arange(count, dtype=np.uint64)


_SIGNED = "doc_id bigint, text_key binary, n_shingles bigint, bands array<bigint>, sketch binary"


def _sign(batches: Iterator[pa.RecordBatch], band_rows: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        ids = batch.column(0)
        texts = batch.column(1).cast(pa.binary())
        at = 0
        while at < len(texts):
            keys, counts, sets, size, first = [], [], [], 0, at
            while at < len(texts) and size < CHUNK:
                words = words_of(texts[at].as_py())
                found = np.unique(shingle_hashes(hashes.of(words), WIDTH))
                keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest()
                            if words else None)
                counts.append(len(found))
                sets.append(found)
                size += len(found)
                at += 1
            filled = np.array([c > 0 for c in counts], bool)
            bands: list = [None] * len(counts)
            sketches: list = [None] * len(counts)
            if filled.any():
                sizes = np.array(counts)[filled]
                signatures = min_max(np.concatenate(sets), np.concatenate(([0], np.cumsum(sizes)[:-1])))
                keyed = band_hashes(signatures, band_rows).view(np.int64)
                short = _short(signatures)
                for i, row in enumerate(np.flatnonzero(filled)):
                    bands[row], sketches[row] = keyed[i], short[i].tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, at - first), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "bands", "sketch"])


def _with(function: Callable, value) -> Callable:
    """A function of batches alone."""
    return lambda batches: function(batches, value)


def signed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: int = SHARE) -> DataFrame:
    """Per row: doc_id, key of its word sequence, set size, band keys, one-byte sketch."""
    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(text_column).cast("string").alias("text")).mapInArrow(
                           _with(_sign, limits(share).rows), _SIGNED)


def _confirm(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    last, known = None, None
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        left, right = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
        keep = []
        for i in range(len(a)):
            if known is None or a[i] != last:
                last = a[i]
                known = np.unique(shingle_hashes(hashes.of(words_of(left[i].as_py())), WIDTH))
            other = np.unique(shingle_hashes(hashes.of(words_of(right[i].as_py())), WIDTH))
            common = len(np.intersect1d(known, other, assume_unique=True))
            if common and 100 * common >= share * (len(known) + len(other) - common):
                keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())],
            ["a", "b"])


def confirmed(pairs: DataFrame, texts: DataFrame, share: int = SHARE) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough; texts: doc_id, text.

    The rarer end's text travels to the commoner end's, which meets all of its
    pairs in one sorted run and is hashed once.
    """
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        _with(_confirm, share), "a bigint, b bigint")


def _similar_length(m: str, n: str, share: int):
    return (100 * F.least(m, n) >= share * F.greatest(m, n))


def _short(signatures: np.ndarray) -> np.ndarray:
    return (mixed(signatures) >> np.uint64(56)).astype(np.uint8)


def _widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        wide = []
        for text in batch.column(1).cast(pa.binary()):
            found = np.unique(shingle_hashes(hashes.of(words_of(text.as_py())), WIDTH))
            wide.append(_short(min_max(found, np.zeros(1, int), PERMUTATIONS, WIDE)).tobytes() if len(found) else b"")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(wide, pa.binary())], ["wide_id", "wide"])


def _close_pairs(batches: Iterator[pa.RecordBatch], least: Limits) -> Iterator[pa.RecordBatch]:
    """Pairs of different components within each run of (bucket, i, j) whose sketches agree.

    A run holds at most two blocks of a bucket; only survivors leave the task, and of the
    buckets that two sets share only the first one reports the pair (of buckets with the same
    members only the one of the first band is here).
    """
    held: list = []
    run = None

    def pairs(rows: list) -> pa.RecordBatch:
        bucket, i, j = rows[0][:3]
        part, rep, n, comp = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 5, 6))
        sketch, wide = (np.frombuffer(b"".join(r[k] for r in rows), np.uint8).reshape(len(rows), -1) for k in (7, 8))
        bands = np.array([r[9] for r in rows], np.int64)
        out: list = []
        for x in range(len(rows)) if i == j else np.flatnonzero(part == i):
            others = np.flatnonzero((comp != comp[x]) & (rep > rep[x] if i == j else part == j)
                                    & (100 * np.minimum(n, n[x]) >= least.share * np.maximum(n, n[x])))
            if len(others):
                others = others[(sketch[others] == sketch[x]).sum(axis=1) >= least.agree]
            if len(others):
                shared = bands[others] == bands[x]
                others = others[bands[x][shared.argmax(axis=1)] == bucket]
            if len(others):
                others = others[(wide[others] == wide[x]).sum(axis=1) >= least.wide_agree]
                out += [(min(rep[x], rep[y]), max(rep[x], rep[y])) for y in others]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())],
            ["a", "b"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:3] != run:
                if len(held) > 1:
                    yield pairs(held)
                run, held = row[:3], []
            held.append(row)
    if len(held) > 1:
        yield pairs(held)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    share: int = SHARE) -> DataFrame:
    """Component of every document under "at least ``share`` % of the shingles in common".

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable, itself
    included) and kept (doc_id = component_id), one row per row of ``docs``.

    1.  Rows with the same words form one class, represented by its smallest id.
    2.  Every crowded band bucket links its members to one of them, the one that meets most others
        in all its buckets: as many candidates as members, whatever the bucket's size.
        Confirmed links give components.
    3.  Where a bucket still holds several components, its rows are dealt into blocks
        of about 1,000 and blocks meet in pairs; pairs inside a component need no
        confirmation, the others leave the task only when sizes and sketches allow
        the similarity, and are confirmed as well.

    Null or blank texts have no shingles and stand alone.  A null doc_id belongs to
    the class of its words when that has an id, and otherwise stands alone with a
    null component and kept = true.  Repeated rows share their component; rows that
    repeat a doc_id with other words are joined only if those words are the
    class representatives of that id.  No rows give no rows.
    """
    least = limits(share)
    rows = written_once(signed(docs, id_column, text_column, share))
    full = rows.where(F.col("text_key").isNotNull())
    classes = written_once(full.groupBy("text_key").agg(F.min("doc_id").alias("rep"),
                                                        F.max("n_shingles").alias("n")))
    reps = written_once(
        full.join(classes.select(F.col("text_key"), F.col("rep").alias("doc_id")), ["text_key", "doc_id"])
        .dropDuplicates(["text_key", "doc_id"])
        .select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "bands", "sketch"))
    banded = reps.select("rep", "n", F.explode("bands").alias("bucket"))
    # A bucket's hub is its member with the most company over all its buckets: what copies were made
    # from shares buckets with all of them, a copy only with some, whatever their ids are.
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = written_once(banded.join(sizes, "bucket"))
    company = shared.groupBy("rep").agg(F.sum("members").alias("company"))
    hubs = shared.join(company, "rep").groupBy("bucket").agg(
        F.max_by(F.struct("rep", "n"), F.struct("company", -F.col("rep"))).alias("hub")).select(
        "bucket", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n"))
    crowded = written_once(shared.drop("members").join(hubs, "bucket"))
    star = written_once(
        crowded.where((F.col("rep") != F.col("hub")) & _similar_length("n", "hub_n", share))
        .select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct())
    # Texts are read again for members of crowded buckets only; the ids that say which are looked
    # up in place while a million of them suffices.
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                        F.col(text_column).cast("string").alias("text"))
    crowd = crowded.select(F.col("rep").alias("doc_id")).distinct()
    met = written_once(lookup(texts, crowd, ["doc_id"], "left_semi", F.col("doc_id")))

    def links_of(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        part = lookup(met, ends, ["doc_id"], "left_semi", F.col("doc_id"))
        return written_once(confirmed(pairs, part, share).distinct())

    links = links_of(star)
    labels = components(links)
    placed = written_once(
        crowded.join(labels, F.col("rep") == F.col("node"), "left")
        .select("bucket", "rep", "n", F.coalesce("component", "rep").alias("comp")))
    # Similar sets meet in many buckets; of buckets with the same members one is enough.  An id
    # that stands for two texts of a bucket cancels in the xor, not in the sum.
    open_buckets = (
        placed.groupBy("bucket")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("members"),
             F.min("rep").alias("first"), F.max("rep").alias("last"),
             F.bit_xor(F.xxhash64("rep")).alias("mark"), F.sum(F.shiftright(F.xxhash64("rep"), 32)).alias("sum"))
        .where(F.col("low") != F.col("high"))
        .groupBy("members", "first", "last", "mark", "sum")
        .agg(F.min_by("bucket", F.col("bucket").bitwiseAND(31)).alias("bucket"))
        .select("bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("parts"))
    )
    unsettled = written_once(placed.join(open_buckets, "bucket"))
    unknown = unsettled.select(F.col("rep").alias("doc_id")).distinct()
    wide = written_once(lookup(met, unknown, ["doc_id"], "left_semi", F.col("doc_id"))
                        .mapInArrow(_widen, "wide_id bigint, wide binary"))
    meeting = (
        unsettled.join(reps.select("rep", "sketch", "bands"), "rep")
        .join(wide, F.col("rep") == F.col("wide_id"))
        .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("bucket", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"),
                "part", "rep", "n", "comp", "sketch", "wide", "bands")
        .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    )
    rest = written_once(
        meeting.mapInArrow(_with(_close_pairs, least), "a bigint, b bigint").distinct()
        .join(star, ["a", "b"], "left_anti"))
    labels = components(links.union(links_of(rest)))
    named = classes.join(labels, F.col("rep") == F.col("node"), "left").select(
        "text_key", F.coalesce("component", "rep").alias("component_id"))
    placed_rows = full.select("doc_id", "n_shingles", "text_key").join(named, "text_key", "left").select(
        "doc_id", "n_shingles", "component_id")
    alone = rows.where(F.col("text_key").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed_rows.unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_per_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  share: int = SHARE) -> DataFrame:
    """One row of every group of near duplicates, with all its columns.

    The row with the smallest id stays, rows without an id after all others.  Every row counts by
    itself: rows that repeat an id are copies only if their texts are, and copies without an id are
    copies like any other.  Rows without words have no group and all stay.  The rows are stored once
    with a key of their own, which takes the place of the id.
    """
    keyed = written_once(docs.select(F.struct("*").alias("packed"), F.monotonically_increasing_id().alias("row")))
    texts = keyed.select("row", F.col("packed").getField(text_column).alias("text"))
    found = written_once(near_duplicates(texts, "row", "text", share).select(
        F.col("doc_id").alias("row"), "component_id"))
    order = F.struct(F.col("packed").getField(id_column).cast("bigint").isNull().alias("nameless"),
                     F.col("packed").getField(id_column).cast("bigint").alias("id"), "row")
    placed = found.join(keyed.select("row", order.alias("order")), "row")
    kept = placed.groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first.row").alias("row"))
    # Copies are fewer than what stays, so they are what is looked up in place.
    lost = found.select("row").join(kept, "row", "left_anti")
    return lookup(keyed, lost, ["row"], "left_anti", F.col("row")).select("packed.*")
