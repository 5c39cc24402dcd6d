import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from answerloom.functions import ids as I
from answerloom.functions import text as X


def one(spark, expression, *values):
    """Apply a column function to a list of strings, in order."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in frame.select("i", expression(F.col("x"))).orderBy("i").collect()]


def test_clean_newlines(spark):
    assert one(spark, X.clean_newlines, "a\n\nb", "a\\n\\nb", "a\\nb\nc", "\n\n\n") == [
        "a b", "a b", "a b c", "  "]


def test_whitelist_variants(spark):
    assert one(spark, X.clean_whitelist, " A-b, é 한글\u00a0! ") == ["a-b, 한글 !"]
    assert one(spark, lambda c: X.clean_whitelist(c, False), "A-b, é 한글 !") == ["a b 한글"]


def test_whitelist_reads_kept_runs_once(spark):
    """Every character against the list, and one pass of a pattern, not one replacement for each refused character."""
    texts = ["x" + chr(c) + chr(c) + "y" for c in [*range(0x3200), *range(0xAB00, 0xD800), 0x1F600]]
    spoken = set("abcdefghijklmnopqrstuvwxyz0123456789") | {
        chr(c) for low, high in ("ㄱㅎ", "ㅏㅣ", "가힣") for c in range(ord(low), ord(high) + 1)}
    for keep, marks in ((True, set("~₩!@#$%^&*()_+|{}:\"<>?`-=\\[];',./")), (False, set())):
        kept = spoken | marks
        want = ["".join(c if c in kept else " " for c in t.lower()) for t in texts]
        assert one(spark, lambda c: X.clean_whitelist(c, keep), *texts) == [" ".join(w.split()) for w in want]
        assert "regexp_replace" not in str(X.clean_whitelist(F.col("text"), keep))


def test_normalize_fixtures(spark):
    given_, want = zip(("The  Cat's hat!", "cats hat"), ("Ça a l'été", "ça lété"),
                       ("한국 a 글", "한국 글"), ("", ""), ("a\u00a0the x_y", "xy"),
                       ("a an the", ""), ("an ant then athena", "ant then athena"))
    assert one(spark, X.normalize_answer, *given_) == list(want)


def scanned(text):
    """One walk over the characters: punctuation vanishes, letters and digits gather in a run
    that an article does not survive, everything else ends the run."""
    out, run = [], ""
    for c in [*text.lower(), " "]:
        if 32 < ord(c) < 127 and not c.isalnum():
            continue
        if c.isalnum():
            run += c
            continue
        out.append(" " if run in ("a", "an", "the") else run)
        out.append(" " if c.isspace() else c)
        run = ""
    words = "".join(out).split(" ")
    return " ".join(w for w in words if w)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(
    alphabet="aAnNthTHeE éüß한글_-.,!'\u00a0\u2003\u3000\t\n\u0085x1½²", max_size=60),
    min_size=20, max_size=40))
def test_normalize_matches_the_definition(spark, texts):
    assert one(spark, X.normalize_answer, *texts) == [scanned(t) for t in texts]


def test_strip_is_unicode(spark):
    assert one(spark, X.strip, "\u00a0 a b \u3000\n", "") == ["a b", ""]


def test_sentences_join_back(spark):
    text = "One.  Two!\nThree? Four"
    assert one(spark, X.sentence_lines, text) == ["One.\nTwo!\nThree?\nFour"]
    assert one(spark, X.canonical, text) == ["One. Two! Three? Four"]


def test_prompts(spark):
    frame = spark.createDataFrame([("t", "q", "c", "a")], "t string, q string, c string, a string")
    row = frame.select(
        X.qa_prompt(F.col("q"), F.col("c"), F.col("t")), X.qa_prompt(F.col("q"), F.col("c")),
        X.qa_target(F.col("a")), X.decorate_title(F.col("t")),
        X.context_prompt(F.col("t"), F.col("c"), F.col("q"))).first()
    assert tuple(row) == ("제목: t 질문: q  글: c </s>", "질문: q  글: c </s>", "a </s>",
                          "제목: t 글: ", "t 글: c질문: q")


@pytest.mark.parametrize("label,want", [
    ("12-3", (12, 3)), ("7", (7, None)), ("x-1", (None, 1)), ("-1", (None, 1))])
def test_split_passage_label(spark, label, want):
    frame = spark.createDataFrame([(label,)], "x string")
    assert tuple(frame.select(I.article_part(F.col("x")), I.paragraph_part(F.col("x"))).first()) \
        == want


def test_packed_ids_sort_like_pairs(spark):
    frame = spark.createDataFrame([(10, 0), (9, 0), (9, 12), (10, 2)], "a long, p int")
    got = frame.orderBy(I.passage_id(F.col("a"), F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(9, 0), (9, 12), (10, 0), (10, 2)]


def test_content_key_keeps_columns_apart(spark):
    frame = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), ("", None), (None, ""), ("", "")], "t string, x string")
    assert frame.select(I.content_key(F.col("t"), F.col("x"))).distinct().count() == 5


def test_first_answer_of_empty_list_is_null(spark):
    frame = spark.createDataFrame(
        [((["x", "y"], [1, 2]),), (([], []),)],
        "answers struct<text: array<string>, answer_start: array<int>>")
    assert {r[0] for r in frame.select(I.first_answer(F.col("answers"))).collect()} == {"x", None}


def test_hash_split_is_stable_and_disjoint(spark):
    ids = spark.range(20000)
    share = ids.repartition(7).where(I.in_test_split(0.2, 5, F.col("id"))).count()
    assert share == ids.repartition(3).where(I.in_test_split(0.2, 5, F.col("id"))).count()
    assert 3700 < share < 4300
