"""The piece encoder against the library."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from answerloom.llm.pieces import codec, decoded, default_model, encoded


@pytest.fixture(scope="module")
def coder():
    return codec(default_model())


def same(coder, text):
    want = coder.library.encode(text, add_bos=True, add_eos=True)
    assert list(coder.encode(text)) == want
    assert coder.decode(want) == coder.library.decode(want)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_any_text(text):
    same(codec(default_model()), text)


def test_pieces_in_any_order(coder):
    draw = random.Random(3)
    pieces = [p.replace("▁", " ") for p in coder.id_of]
    for _ in range(3000):
        same(coder, "".join(draw.choice(pieces) for _ in range(draw.randint(1, 9))))


def test_long_runs(coder):
    for text in ("ab" * 20000, " " * 5000, "é" * 3000, "\n\t" * 2000, "aaaa" * 5000 + "b"):
        same(coder, text)


def test_id_lists_no_text_encodes_to(coder):
    draw = random.Random(4)
    for _ in range(3000):
        ids = [draw.choice([0, 1, 2, draw.randrange(32000), draw.randrange(3, 259), 29871])
               for _ in range(draw.randint(0, 6))]
        assert coder.decode(ids) == coder.library.decode(ids)


def test_query_rows(spark, coder):
    texts = [(1, "Hello  world\n"), (2, None), (2, ""), (None, "x" * 70000), (3, "Hello  world\n")]
    frame = spark.createDataFrame([(*t, "extra", 5) for t in texts],
                                  "doc_id bigint, text string, ids string, n_tokens int")
    found = encoded(frame)
    rows = {(r["doc_id"], r["n_tokens"]): r for r in found.collect()}
    assert found.count() == 5 and rows[(2, 2)]["ids"] == [1, 2]
    want = coder.library.encode("Hello  world\n", add_bos=True, add_eos=True)
    row = rows[(1, len(want))]
    assert row["ids"] == want
    assert row["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256("Hello  world\n".encode()).hexdigest()
    back = {(r["doc_id"], r["text"]) for r in decoded(found).collect()}
    assert back == {(i, t or "") for i, t in texts}
    assert encoded(frame.limit(0)).count() == 0


def test_search_goes_on_where_the_longest_pieces_stop(coder, monkeypatch):
    """Pieces found before the first misfit are not looked for again."""
    begun, search = [], coder._searched
    monkeypatch.setattr(coder, "_searched", lambda text, out, piece: begun.append(len(out)) or search(text, out, piece))
    for word in ("thtionerthandinghewh", "ciónueadomiósque", "dieschschbertzenpf", "oferndretihaonble"):
        text = word * 3
        assert coder.encode(text).tolist() == coder.library.encode(text, add_bos=True, add_eos=True)
    assert begun and max(begun) > 1
