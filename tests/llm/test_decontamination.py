"""Benchmark windows against a plain search of word lists."""

import hashlib
import re

import pytest

from answerloom.llm.decontamination import contamination, decontaminated, hits

DOCS = "doc_id bigint, text string, row int, words string"
ITEMS = "item_id bigint, text string, window string"
TEN = "the quick brown fox jumps over the lazy old dog"


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                      "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    cut = [("" if i is None else str(i), plain_words(t)) for i, t, _ in items]
    windows = {}
    for item, w in cut:
        n = min(len(w), 10)
        for at in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[at:at + n]), set()).add(item)
    for doc_id, text, _, _ in docs:
        w, hit, found = plain_words(text), set(), set()
        for at in range(len(w)):
            for n in range(1, 11):
                if at + n <= len(w) and (held := windows.get(tuple(w[at:at + n]))):
                    hit |= set(range(at, at + n))
                    found |= held
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


DOC_ROWS = [
    (1, f"So {TEN.upper()}, said he. {TEN}!", 1, "w"), (2, "nothing to see here", 1, "w"), (3, None, 1, "w"), (4, "", 1, "w"),
    (5, "..., --", 1, "w"), (6, TEN.replace(" ", "-\n"), 1, "w"), (7, "the quick brown fox jumps over the lazy old cat", 1, "w"),
    (8, "ÉCOLE normale", 1, "w"), (9, "école normale École", 1, "w"), (None, TEN, 1, "w"), (None, f"x {TEN}", 1, "w"),
    (10, TEN, 1, "w"), (10, f"{TEN} again", 1, "w"), (11, "a1 b2 " * 3000 + TEN + " z" * 5000, 1, "w"),
    (12, "one two three one two three one two three", 1, "w"), (13, "\U0001F600 smile [INST]\x00x", 1, "w"),
]
ITEM_ROWS = [
    (1, f"{TEN} and runs away"), (2, f"We say {TEN}"), (10, TEN), (3, "école"), (4, None), (5, "?!"), (None, "one two three one"),
    (7, "École Normale"), (7, "smile"), (8, "a1 b2 a1 b2 a1 b2 a1 b2 a1 b2 a1"), (9, "never ever seen words of an item that is long enough"),
]
ITEM_ROWS = [(i, t, "w") for i, t in ITEM_ROWS]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_equals_brute_force(spark, limit):
    docs, items = spark.createDataFrame(DOC_ROWS, DOCS), spark.createDataFrame(ITEM_ROWS, ITEMS)
    got = sorted((tuple(r) for r in contamination(docs, items, broadcast_windows=limit).collect()), key=repr)
    assert got == brute(DOC_ROWS, ITEM_ROWS)
    assert sum(r[-1] for r in got) == 9 + 2


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(DOC_ROWS, DOCS), spark.createDataFrame(ITEM_ROWS, ITEMS)
    assert contamination(docs.limit(0), items).collect() == []
    clean = contamination(docs, items.limit(0)).collect()
    assert len(clean) == len(DOC_ROWS) and not any(r["contaminated"] for r in clean)
    assert {r["items_sha256"] for r in clean} == {hashlib.sha256(b"").hexdigest()}


def test_cuts_and_drops(spark):
    docs, items = spark.createDataFrame(DOC_ROWS, DOCS), spark.createDataFrame(ITEM_ROWS, ITEMS)
    cut = decontaminated(docs, items)
    assert cut.columns == docs.columns
    texts = {}
    for r in cut.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert texts[1] == ["So, said he!"] and texts[2] == ["nothing to see here"] and texts[3] == [None]
    assert sorted(texts[None]) == ["", "x"] and sorted(texts[10]) == ["", " again"]
    assert texts[11] == [" z" * 5000] and texts[12] == [" two three"]
    assert not any(r["contaminated"] for r in contamination(cut, items).collect())
    whole = decontaminated(docs, items, whole=True)
    bad = {tuple(r) for r in contamination(docs, items).collect() if r["contaminated"]}
    assert whole.count() == len(DOC_ROWS) - len(bad) and {r["doc_id"] for r in whole.collect()} == {2, 3, 4, 5, 7}


def test_one_passage_in_most_documents(spark):
    rows = [(i, f"{TEN} w{i}" if i % 3 else f"w{i} x", 1, "w") for i in range(600)]
    items = [(i, f"{TEN} v{i // 2}", "w") for i in range(200)]
    got = sorted((tuple(r) for r in contamination(spark.createDataFrame(rows, DOCS).repartition(5),
                                                   spark.createDataFrame(items, ITEMS)).collect()), key=repr)
    assert got == brute(rows, items)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_aggregate_reads_no_words(spark, limit):
    """Hits are sorted and spilled where they are gathered; the words of whole texts must not be."""
    docs, items = spark.createDataFrame(DOC_ROWS, DOCS), spark.createDataFrame(ITEM_ROWS, ITEMS)
    found = hits(docs.select("row", "doc_id", "text"), items, broadcast_windows=limit)[0]
    plan = found._jdf.queryExecution().optimizedPlan()
    read = plan.children().head().output()
    assert plan.nodeName() == "Aggregate"
    assert {read.apply(i).name() for i in range(read.size())} == {"row", "doc_id", "hit"}
