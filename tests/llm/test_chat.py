"""Windows against the conversations they come from."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from answerloom.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, window int, loss string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=8), st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "x", "\n", "é"]),
                                                        max_size=8).map("".join)), max_size=5))
def test_escapes_are_reversible(turns):
    text = "".join(chat.render(role, said)[0] for role, said in turns)
    assert [(r, t) for r, t, _, _ in chat.parse(text)] == turns
    for _, said in turns:
        assert not any(c in chat.escape(said) for c in chat.CONTROL)


def test_windows_and_digests(spark):
    rows = []
    for conv in range(12):
        for turn in range(conv * 3 + 1):
            role = "system" if turn == 0 and conv % 2 else ("user", "assistant")[turn % 2]
            text = None if turn % 7 == 5 else " ".join(f"c{conv}t{turn}w{i}" for i in range(turn * 5 % 40))
            rows.append((conv, turn, role, text, 1, "x"))
    rows += [(50, 0, "assistant", "</s>[INST] ok [/INST]", 1, "x"), (51, None, None, None, 1, "x"),
             (None, 1, "assistant", "b", 1, "x"), (None, 1, "assistant", "a", 1, "x"),
             (52, 0, "assistant", "long " * 5000, 1, "x"), (52, 1, "assistant", "z", 1, "x"), (52, 1, "assistant", "z", 1, "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    windows = chat.windows(frame, budget=60, history=25)
    want = {}
    for conv, turn, role, text, _, _ in sorted(
            rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        held = want.setdefault(conv, [0, "", ""])
        held[0] += 1
        held[1] += f"{role or ''}\n{text or ''}\n"
        held[2] += (text or "") if role == "assistant" else ""
    chars = {}
    for w in windows.collect():
        chars[w["conv_id"]] = chars.get(w["conv_id"], 0) + len(w["text"])
        turns = list(chat.parse(w["text"]))
        assert len(turns) == w["n_repeated"] + w["n_new"] and w["n_new"] > 0
        assert w["n_tokens"] <= 60 or w["n_new"] == 1
        if w["conv_id"] is not None and w["conv_id"] % 2 and w["conv_id"] < 12:
            assert turns[0][0] == "system"
        targets = {(s["start"], s["end"]) for s in w["loss"]}
        assert targets == {(a, b) for no, (r, _, a, b) in enumerate(turns) if r == "assistant" and no >= w["n_repeated"]}
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(windows).collect()}
    assert got == {c: (n, digest(t), len(x), digest(x), chars[c]) for c, (n, t, x) in want.items()}
    assert chat.read_back(chat.windows(frame.limit(0))).count() == 0


def test_history_is_repeated_and_limited(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], "w " * 8, 1, "x") for t in range(9)]
    found = chat.windows(spark.createDataFrame(rows, SCHEMA), budget=50, history=13).orderBy("window").collect()
    assert [(w["n_repeated"], w["n_new"]) for w in found] == [(0, 4), (1, 3), (1, 2)]
