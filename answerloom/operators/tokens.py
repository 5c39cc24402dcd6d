"""Token sets from a corpus vocabulary: encoding, padding, trimming."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.functions.text import strip
from answerloom.operators.numbering import numbered_in_order
from answerloom.operators.skew import lookup, skew_join
from answerloom.operators.stored import written_once

# Reserved ids in front of the learned vocabulary.
PAD, UNKNOWN, START, SEPARATOR = 0, 1, 2, 3
TAGS = {"제목:": 4, "글:": 5, "질문:": 6, "</s>": 7}
FIRST_WORD = 8
# Length limits.
QUESTION_LENGTH, PAIR_LENGTH, SOURCE_LENGTH, LABEL_LENGTH = 256, 256, 1024, 128
BROADCAST_TOKENS = 1_000_000
# A tag, a run of letters and digits, or one other visible character.
TOKEN = (r"제목:|글:|질문:|</s>|[\p{L}\p{N}]+"
         r"|[^\p{L}\p{N}\x09-\x0D\x1C-\x20\x{85}\p{Z}]")


def token_strings(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def vocabulary(texts: DataFrame, text_col: str, size: int | None = None) -> DataFrame:
    """(token, token_id): tags first, then all tokens, the most frequent first.

    Counts combine before the shuffle and tokens are numbered by ranges of (count,
    token), so any number of them is spread over tasks.  ``size`` keeps the most
    frequent ones only.
    """
    counted = (
        texts.select(F.explode(token_strings(F.col(text_col))).alias("token"))
        .where(~F.col("token").isin(list(TAGS)))
        .groupBy("token").agg(F.count("*").alias("_n"))
    )
    placed = numbered_in_order(counted, F.desc("_n"), F.asc("token"))
    if size is not None:
        placed = placed.where(F.col("position") < size)
    learned = placed.select("token", (F.col("position") + FIRST_WORD).cast("int").alias("token_id"))
    tags = ", ".join(f"('{token}', {number})" for token, number in TAGS.items())
    reserved = texts.sparkSession.sql(f"SELECT * FROM VALUES {tags} AS t(token, token_id)")
    return reserved.unionByName(learned)


def encode(rows: DataFrame, id_col: str, columns: dict[str, tuple[str, int]], vocab: DataFrame,
           broadcast_tokens: int = BROADCAST_TOKENS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep ..., name array<int>, ...): tokens of each column as vocabulary ids.

    ``columns`` maps an output name to (text column, token limit), ``keep`` names
    columns that are passed through.  A vocabulary of
    up to ``broadcast_tokens`` rows is broadcast and looked up batch by batch, so
    encoding is a narrow step.  Of a larger one the ids below that number are, which a learned
    vocabulary gives to its most frequent tokens; only places of other tokens meet the rest in a join.
    """
    cut = rows.select(id_col, *keep, *[
        F.slice(token_strings(F.coalesce(text, F.lit(""))), 1, limit).alias(name)
        for name, (text, limit) in columns.items()])
    head = vocab.select("token", "token_id").limit(broadcast_tokens + 1).toArrow()
    if head.num_rows <= broadcast_tokens:
        return _looked_up(cut, (id_col, *keep), tuple(columns), head).drop("_missed")
    frequent = F.coalesce(F.col("token_id") < broadcast_tokens, F.lit(False))
    head = vocab.where(frequent).select("token", "token_id").toArrow()
    # Rows are told apart by a key of their own: ids may repeat or be missing.
    found = written_once(_looked_up(cut.withColumn("_row", F.monotonically_increasing_id()),
                                    ("_row", id_col, *keep), tuple(columns), head))
    return _with_rare(found, tuple(columns), vocab.where(~frequent)).select(id_col, *keep, *columns)


def _looked_up(cut: DataFrame, keep: tuple[str, ...], names: tuple[str, ...], head: pa.Table) -> DataFrame:
    """(keep ..., name array<int> ..., _missed): tokens as the ids of ``head``, UNKNOWN for the others.

    ``_missed`` lists the places of the others: number of the column, place and token.
    """
    shared = cut.sparkSession.sparkContext.broadcast(
        (head["token"].combine_chunks(), head["token_id"].combine_chunks().cast(pa.int32())))
    n_keep = len(keep)

    def run(batches):
        tokens, numbers = shared.value
        # Tokens stay in Arrow, as strings of Python they would take some ten times the memory of a worker.
        # The last entry answers what was not found (-1).
        numbers = np.append(numbers.to_numpy(), UNKNOWN).astype(np.int32)
        for batch in batches:
            lists = batch.columns[n_keep:]
            sizes = np.array([x.value_lengths().to_numpy() for x in lists])
            words = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
            places = words.indices.to_numpy()
            at = pc.fill_null(pc.index_in(words.dictionary, tokens), -1).to_numpy()[places]
            ids = numbers[at]
            encoded, start = batch.columns[:n_keep], 0
            for size in sizes:
                encoded.append(_lists(size, pa.array(ids[start:start + size.sum()])))
                start += size.sum()
            # Lists follow one another column by column; what was missed goes back to its row.
            gaps = np.flatnonzero(at < 0)
            ends = np.cumsum(sizes.ravel())
            cell = np.searchsorted(ends, gaps, side="right")
            name, row = np.divmod(cell, batch.num_rows)
            within = gaps - (ends - sizes.ravel())[cell]
            order = np.argsort(row, kind="stable")
            missed = pa.StructArray.from_arrays(
                [pa.array(name[order].astype(np.int32)), pa.array(within[order].astype(np.int32)),
                 words.dictionary.take(pa.array(places[gaps[order]]))], ["name", "at", "token"])
            encoded.append(_lists(np.bincount(row, minlength=batch.num_rows), missed))
            yield pa.RecordBatch.from_arrays(encoded, [*batch.schema.names, "_missed"])

    schema = [f"{name} {cut.schema[name].dataType.simpleString()}" for name in keep]
    schema += [f"{name} array<int>" for name in names]
    return cut.select(*keep, *names).mapInArrow(
        run, ", ".join([*schema, "_missed array<struct<name: int, at: int, token: string>>"]))


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def _with_rare(found: DataFrame, names: tuple[str, ...], rare: DataFrame) -> DataFrame:
    """The stored rows with the ids of ``rare`` at missed places; rows without such places stay where they are."""
    places = found.select("_row", F.explode("_missed").alias("_m")).select("_row", "_m.name", "_m.at", "_m.token")
    # At most the token limits of all columns per row.
    known = skew_join(places, rare, ["token"], "inner", F.col("_row")).groupBy("_row").agg(
        F.collect_list(F.struct("name", "at", "token_id")).alias("_known"))
    gaps = F.size("_missed") > 0
    patched = found.where(gaps).join(known, "_row", "left")

    def filled(no: int, name: str) -> Column:
        own = F.filter("_known", lambda k: k["name"] == no)
        ids = F.map_from_arrays(F.transform(own, lambda k: k["at"]), F.transform(own, lambda k: k["token_id"]))
        # The map is made once per row: a one-element list carries it into the walk over the places.
        walk = F.transform(F.array(ids), lambda m: F.transform(
            name, lambda x, i: F.coalesce(F.try_element_at(m, i), x)))
        return F.when(F.size(own) > 0, F.get(walk, F.lit(0))).otherwise(F.col(name)).alias(name)

    rest = [c for c in found.columns if c not in names and c != "_missed"]
    return found.where(~gaps).select(*rest, *names).unionByName(
        patched.select(*rest, *[filled(no, name) for no, name in enumerate(names)]))


def decode(rows: DataFrame, id_col: str, ids_col: str, vocab: DataFrame, **sizes: int) -> DataFrame:
    """(id, text): the tokens of ``ids_col`` joined by spaces, stripped.

    Reserved ids (padding, marks, tags) give nothing.  A missing list gives a missing text;
    ids may repeat or be missing.
    """
    placed = written_once(rows.select(id_col, F.col(ids_col).alias("_ids")).withColumn(
        "_row", F.monotonically_increasing_id()))
    unrolled = placed.select("_row", F.posexplode("_ids").alias("_at", "token_id")).where(
        F.col("token_id") >= FIRST_WORD)
    known = lookup(unrolled, vocab.select("token_id", "token"), ["token_id"], "inner", F.col("_row"), **sizes)
    texts = known.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_at", "token"))).alias("_tokens"))
    joined = placed.join(texts, "_row", "left")
    text = strip(F.array_join(F.col("_tokens.token"), " "))
    return joined.select(id_col, F.when(F.col("_ids").isNotNull(), F.coalesce(text, F.lit(""))).alias("text"))


def pad_to(ids: Column, length: int | Column, value: int = PAD) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(value), (F.lit(length) - F.size(ids)).cast("int")))


def mask_to(ids: Column, length: int) -> Column:
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)),
                    F.array_repeat(F.lit(0), F.lit(length) - F.size(ids)))


def _one(value: int) -> Column:
    return F.array(F.lit(value))


def _question_inputs(ids: str, length: int, prefix: str = "") -> list[Column]:
    """start + question + separator: ids, mask and types, padded."""
    framed = F.concat(_one(START), F.col(ids), _one(SEPARATOR))
    return [pad_to(framed, length).alias(prefix + "input_ids"),
            mask_to(framed, length).alias(prefix + "attention_mask"),
            F.array_repeat(F.lit(0), length).alias(prefix + "token_type_ids")]


def _with_cut_pair(rows: DataFrame, first: str, second: str, room: int) -> DataFrame:
    """Cut tokens from the longer part until both fit; the first keeps the odd one."""
    keep = F.least(F.size(first), F.greatest(F.lit(room) - F.size(second), F.lit((room + 1) // 2)))
    return rows.withColumn(first, F.slice(first, F.lit(1), keep)).withColumn(
        second, F.slice(second, F.lit(1), F.least(F.size(second), F.lit(room) - F.size(first))))


def _pair_inputs(first: str, second: str, length: int, prefix: str = "") -> list[Column]:
    """start + first + separator + second + separator: ids, mask and types, padded."""
    framed = F.concat(_one(START), first, _one(SEPARATOR), second, _one(SEPARATOR))
    types = F.concat(F.array_repeat(F.lit(0), F.size(first) + 2),
                     F.array_repeat(F.lit(1), F.size(second) + 1))
    return [pad_to(framed, length).alias(prefix + "input_ids"),
            mask_to(framed, length).alias(prefix + "attention_mask"),
            pad_to(types, length, 0).alias(prefix + "token_type_ids")]


def encode_questions(questions: DataFrame, id_col: str, text_col: str, vocab: DataFrame,
                     length: int = QUESTION_LENGTH) -> DataFrame:
    """Questions truncated and padded to ``length``, with mask and types."""
    ids = encode(questions, id_col, {"_ids": (text_col, length - 2)}, vocab)
    return ids.select(id_col, *_question_inputs("_ids", length))


def encode_pairs(passages: DataFrame, id_col: str, title_col: str, text_col: str,
                 vocab: DataFrame, length: int = PAIR_LENGTH) -> DataFrame:
    """(title, text) pairs in one sequence; the longer part is cut first."""
    room = length - 3
    both = encode(passages, id_col, {"_a": (title_col, room), "_b": (text_col, room)}, vocab)
    return _with_cut_pair(both, "_a", "_b", room).select(id_col, *_pair_inputs("_a", "_b", length))


def encode_training_pairs(pairs: DataFrame, id_col: str, vocab: DataFrame,
                          question_length: int = QUESTION_LENGTH,
                          pair_length: int = PAIR_LENGTH) -> DataFrame:
    """One row per question and its passage: both token sets and the passage's ids.

    Expects question, title, text, article_id and paragraph_id; everything is
    encoded in one narrow step, aligned by row.
    """
    room = pair_length - 3
    ids = encode(pairs, id_col, {"_q": ("question", question_length - 2), "_a": ("title", room),
                                 "_b": ("text", room)}, vocab, keep=("article_id", "paragraph_id"))
    return _with_cut_pair(ids, "_a", "_b", room).select(
        id_col, "article_id", "paragraph_id", *_question_inputs("_q", question_length, "question_"),
        *_pair_inputs("_a", "_b", pair_length, "context_"))


def encode_seq2seq(rows: DataFrame, id_col: str, source_col: str, target_col: str,
                   vocab: DataFrame, source_length: int = SOURCE_LENGTH,
                   label_length: int = LABEL_LENGTH) -> DataFrame:
    """Source ids, mask and labels, truncated, not padded."""
    both = encode(rows, id_col, {"input_ids": (source_col, source_length),
                                 "labels": (target_col, label_length)}, vocab)
    return both.select(
        id_col, "input_ids", F.array_repeat(F.lit(1), F.size("input_ids")).alias("attention_mask"),
        "labels")


def pad_batches(rows: DataFrame, ids_col: str = "ids", value: int = PAD) -> DataFrame:
    """Pad every row to the longest of its batch (a batch is a bounded group)."""
    longest = F.max(F.size(ids_col)).over(Window.partitionBy("batch_id"))
    return (
        rows.withColumn("_longest", longest)
        .withColumn(ids_col, F.concat(ids_col, F.array_repeat(
            F.lit(value), F.col("_longest") - F.size(ids_col))))
        .drop("_longest")
    )


def trim_batches(rows: DataFrame, columns: list[str], ids_col: str = "ids",
                 value: int = PAD) -> DataFrame:
    """Drop positions that are padding in every row of the batch, inner ones too.

    The positions are decided on ``ids_col`` and cut from all ``columns``.  A batch is a
    bounded group, so a window gathers its rows' used positions; the input is read once.
    """
    places = F.transform(ids_col, lambda x, i: F.when(x != value, i))
    used = F.filter(places, lambda i: i.isNotNull())
    kept = F.array_sort(F.array_distinct(F.flatten(F.collect_list("_used").over(
        Window.partitionBy("batch_id")))))
    out = rows.withColumn("_used", F.coalesce(used, F.expr("cast(array() as array<int>)"))).withColumn(
        "_kept", kept)
    return out.withColumns({name: _at(name, "_kept") for name in columns}).drop("_used", "_kept")


def _at(array: str, positions: str) -> Column:
    return F.transform(positions, lambda i: F.get(F.col(array), i))


def batch_tokens(rows: DataFrame, source_col: str, target_col: str,
                 value: int = PAD) -> DataFrame:
    """Per batch: non-pad tokens on both sides and the mean target length."""
    real = lambda name: F.size(F.filter(name, lambda x: x != value))
    return rows.groupBy("batch_id").agg(
        F.count("*").alias("n_rows"),
        F.sum(real(source_col) + real(target_col)).alias("n_tokens"),
        F.avg(F.size(target_col)).alias("mean_target_length"))
