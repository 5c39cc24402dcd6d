"""Text expressions, all JVM-side."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -----------------------------------------------------------
PUNCTUATION = string.punctuation
ARTICLE_WORDS = ("a", "an", "the")
# Code points that Python's str.split() treats as white space.
WHITESPACE = r"[\x09-\x0D\x1C-\x1F\x{85}\p{Z}]+"
# Every run of those except a single plain space, which needs no replacing.
WHITESPACE_RUN = rf" {WHITESPACE}|[\x09-\x0D\x1C-\x1F\x{{85}}\p{{Z}}&&[^ ]]{WHITESPACE[:-1]}*"
# A word character is a letter, a number or "_"; look-arounds state the border
# outright because \b differs between regex engines outside ASCII.
# The literal comes first so that the border checks run at candidates only.
ARTICLE_PATTERN = r"(an?|the)(?![\p{L}\p{N}_])(?<![\p{L}\p{N}_](?:an?|the))"
# Characters kept by the two whitelist cleaners (Hangul, Latin, digits, with and without punctuation).
# ASCII is spelt out: Java looks single characters up in one table, ranges one after the other.
_WORD_CHARACTERS = string.ascii_letters + string.digits + "ㄱ-ㅎㅏ-ㅣ가-힣"
KEPT_WORDS = f"[{_WORD_CHARACTERS}]+"
KEPT_WITH_PUNCTUATION = "[" + _WORD_CHARACTERS + "₩" + "".join("\\" + c for c in PUNCTUATION) + "]+"
BREAK = r"[\t\n\x0B\f\r ]+"
# A break behind the end of a sentence; its first character comes first so that the look-behind runs at breaks only.
SENTENCE_GAP = BREAK[:-1] + "(?<=[.!?]" + BREAK[:-1] + ")" + BREAK[:-1] + "*"
WORD_GAP = r"[^\p{L}\p{N}]+"
TITLE_TAG, TEXT_TAG, QUESTION_TAG, END_TAG = "제목: ", " 글: ", "질문: ", " </s>"
# -------------------------------------------------------------------------


def clean_newlines(text: Column) -> Column:
    """Written and real line breaks become one space, doubled ones first.

    The two kinds share no character, so texts without written ones are not searched for them again.
    """
    # The breaks, in this order.
    written = text
    for mark in ("\\n\\n", "\\n"):
        written = F.replace(written, F.lit(mark), F.lit(" "))
    text = F.when(F.contains(text, F.lit("\\n")), written).otherwise(text)
    for mark in ("\n\n", "\n"):
        text = F.replace(text, F.lit(mark), F.lit(" "))
    return text


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))


def clean_whitelist(text: Column, keep_punctuation: bool = True) -> Column:
    """Lower-case, blank every character outside the whitelist, collapse.

    White space is outside as well, so what stays are the runs of kept characters, joined by spaces.
    """
    kept = KEPT_WITH_PUNCTUATION if keep_punctuation else KEPT_WORDS
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit(kept), F.lit(0)), " ")


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` only removes spaces)."""
    return F.regexp_replace(F.regexp_replace(text, "^" + WHITESPACE, ""), WHITESPACE + "$", "")


def normalize_answer(text: Column) -> Column:
    """Lower, drop ASCII punctuation, blank English articles, collapse spaces."""
    bare = F.translate(F.lower(text), PUNCTUATION, "")
    return collapse_spaces(F.regexp_replace(bare, ARTICLE_PATTERN, " "))


def answer_tokens(text: Column) -> Column:
    """Tokens of the normalised text; an empty text has none."""
    return F.filter(F.split(normalize_answer(text), " ", -1), lambda t: t != "")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), WORD_GAP, -1), lambda t: t != "")


def canonical(text: Column) -> Column:
    """Cleaned text with every sentence gap cut to one space; offsets live here."""
    return F.regexp_replace(clean_newlines(text), SENTENCE_GAP, " ")


def sentences(text: Column, cleaned: bool = False) -> Column:
    """Sentences of the canonical text; joined by one space they give it back.

    ``cleaned`` says that the text comes from ``clean_newlines``, which changes nothing a second time.
    """
    return F.split(text if cleaned else clean_newlines(text), SENTENCE_GAP, -1)


def sentence_lines(text: Column) -> Column:
    """One sentence per line."""
    return F.array_join(sentences(text), "\n")


def canonical_offset(text: Column, start: Column) -> Column:
    """Where raw offset ``start`` lands in the canonical text.

    Cleaning shortens the text, so an answer offset counted on the raw text has
    to move with it: it is the length of the canonical form of the prefix.
    """
    return F.length(canonical(F.substring(text, F.lit(1), start)))


def decorate_title(title: Column) -> Column:
    return F.concat(F.lit(TITLE_TAG), title, F.lit(TEXT_TAG))


def qa_prompt(question: Column, context: Column, title: Column | None = None) -> Column:
    """Generator input; note the two spaces in front of the text tag."""
    asked = F.concat(F.lit(QUESTION_TAG), question, F.lit(" " + TEXT_TAG), context, F.lit(END_TAG))
    if title is None:
        return asked
    return F.concat(F.lit(TITLE_TAG), title, F.lit(" "), asked)


def qa_target(answer: Column) -> Column:
    return F.concat(answer, F.lit(END_TAG))


def context_prompt(title: Column, text: Column, question: Column) -> Column:
    """Retrieved passage followed by the question it was retrieved for."""
    return F.concat(title, F.lit(TEXT_TAG), text, F.lit(QUESTION_TAG), question)
