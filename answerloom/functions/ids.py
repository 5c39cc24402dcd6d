"""Ids, content keys and hash-based splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Paragraphs per article that a packed passage id can hold; 2**24 chunks are more
# than the longest string Spark can store.
PARAGRAPH_BITS = 24
PARAGRAPHS_PER_ARTICLE = 1 << PARAGRAPH_BITS


def content_key(*columns: Column) -> Column:
    """32-byte SHA-256 of the columns, each prefixed with its length.

    The prefix keeps ``("ab", "c")`` apart from ``("a", "bc")``; a NULL differs
    from an empty string.  Grouping and joining on this key moves 32 bytes per
    row instead of whole texts.
    """
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
             for c in columns]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def passage_id(article_id: Column, paragraph_id: Column) -> Column:
    """One BIGINT that sorts like the pair (article_id, paragraph_id)."""
    return (article_id.cast("bigint") * F.lit(PARAGRAPHS_PER_ARTICLE)
            + paragraph_id.cast("bigint"))


def article_of(packed: Column) -> Column:
    return F.shiftright(packed, PARAGRAPH_BITS)


def paragraph_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(PARAGRAPHS_PER_ARTICLE - 1)).cast("int")


def passage_label(article_id: Column, paragraph_id: Column) -> Column:
    """Printable id ``article-paragraph``."""
    return F.concat_ws("-", article_id.cast("string"), paragraph_id.cast("string"))


def article_part(label: Column) -> Column:
    return _to_bigint(F.substring_index(label, "-", 1))


def paragraph_part(label: Column) -> Column:
    return _to_bigint(F.try_element_at(F.split(label, "-", -1), F.lit(2))).cast("int")


def _to_bigint(text: Column) -> Column:
    return F.when(text.rlike(r"^[0-9]{1,18}$"), text.try_cast("bigint"))


def first_answer(answers: Column) -> Column:
    """First text of an answers struct, NULL when there is none."""
    return F.try_element_at(answers.getField("text"), F.lit(1))


def shuffle_key(seed: int, *ids: Column) -> Column:
    """32 hex digits, uniform over distinct ids, the same on every engine."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def hash_number(seed: int, *ids: Column) -> Column:
    """28-bit integer drawn from the ids."""
    return F.conv(F.substring(shuffle_key(seed, *ids), 1, 7), 16, 10).cast("bigint")


def draw_number(seed: int, *ids: Column) -> Column:
    """60-bit integer drawn from the ids; its remainders are as good as even."""
    return F.conv(F.substring(shuffle_key(seed, *ids), 1, 15), 16, 10).cast("bigint")


def in_test_split(fraction: float, seed: int, *ids: Column) -> Column:
    """True for about ``fraction`` of the ids, whatever the partitioning."""
    return hash_number(seed, *ids) < F.lit(int(round(fraction * (1 << 28))))
