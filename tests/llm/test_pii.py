"""Base spans against the plain patterns, EM and redaction."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from answerloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "phone" and not 10 <= len(digits) <= 15
                    or kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits))):
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["4111111111111111", "4111 1111 1111 1111", "a.b@c.de", "@", "+", "1", "0", ".", "-", " ", "x",
                                 "é", "(", ")", "555", "1.2.3.4", "256", "00001", "\n", "%", "+1 (555) 123-4567"]), max_size=14)
       .map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    got = sorted(((k, s, e) for k, s, e, ok in pii.base_matches(text) if ok), key=lambda s: (s[1], pii.KINDS.index(s[0])))
    assert got == plain_spans(text)
    everything = pii.spans_of(text, np.zeros(2 * pii.LABELERS + len(pii.KINDS) + 2))
    assert [s[:3] for s in everything] == got


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.mark.parametrize("text", ["a" * 200_000 + "@", "1" * 200_000, "+1" + "(" * 200_000, "1." * 100_000, "@" * 100_000])
def test_very_long_texts(text):
    assert isinstance(pii.candidates(text), list)


def rows():
    out = []
    for i in range(200):
        out.append((i, f"tel 555-01{i % 10}-44{i % 90 + 10} or call +1 (555) 123-45{i % 90 + 10}, mail user{i}@host.example.com"))
        out.append((1000 + i, f"order {1234567890123456 + i} of version 1.2.3.999 and section 300.1.2.{i}"))
    return [*out, (5000, None), (5001, ""), (None, "x@y.zz"), (None, "x@y.zz"), (5002, "write to jo(at)host(dot)com now")]


def test_query_rows(spark):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows()], "doc_id bigint, text string, spans string, kind int")
    got = pii.find_personal_data(frame).collect()
    assert len(got) == len(rows())
    texts = {}
    for i, t in rows():
        texts.setdefault(i, t)
    for r in got:
        base = plain_spans(texts[r["doc_id"]] or "")
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(filter(None, r["spans"].split(",")))
    spans = {r["doc_id"]: r["spans"] for r in got}
    assert spans[3].startswith("phone:4:16,phone:25:") and spans[5002] == "email:9:27"
    # Of the plain numbers, the base finds those that pass the check digit; nothing is added.
    for i in range(200):
        assert spans[1000 + i] == ",".join(f"{k}:{s}:{e}" for k, s, e in plain_spans(texts[1000 + i]))
    assert 0 < sum(bool(spans[1000 + i]) for i in range(200)) < 40
    assert pii.find_personal_data(frame.limit(0)).count() == 0


def test_redaction(spark):
    frame = spark.createDataFrame([(1, "é mail a@b.cd, 1.2.3.4", 9, "k"), (2, None, None, "k")],
                                  "doc_id bigint, text string, n_chars bigint, kind string")
    got = {r["doc_id"]: tuple(r) for r in pii.redact(frame).collect()}
    assert got == {1: (1, "é mail <EMAIL>, <IP>", 20, "k"), 2: (2, None, None, "k")}
    assert pii.redacted_text("abcdef", [("email", 1, 4, True), ("phone", 2, 5, True)]) == "a<EMAIL>f"


def test_expectation_maximisation_finds_the_bad_labeler():
    draw = np.random.Generator(np.random.PCG64(5))
    truth = draw.random(4000) < 0.6
    votes = np.array([np.where(draw.random(4000) < right, truth, ~truth) for right in (0.9, 0.9, 0.85, 0.8, 0.8, 0.5)]).T * 2 - 1
    code = ((votes + 1) * 3 ** np.arange(6)).sum(axis=1)
    p, tables = pii.estimate(np.zeros(4000, int), code, np.ones(4000))
    assert ((p > 0.5) == truth).mean() > 0.93
    assert tables[1, 0, 2] > 0.85 and abs(tables[1, 5, 2] - 0.5) < 0.1
