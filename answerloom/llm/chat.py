"""Conversations as budgeted training windows.

A window holds a run of whole turns that fits a token budget; prefix sums of the turns'
tokens say where it ends.  Every window after the first opens with the system turn and with the last
turns before it, as many as a smaller budget allows.  Assistant texts are targets; in
repeated turns they are masked, so each is a target exactly once.

Turns are sorted by Spark and read as a stream: a task holds one window, whatever the length
of the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET, HISTORY, MARK_TOKENS = 1024, 192, 4
TURN, END = "<|turn|>", "<|end|>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", TURN, END)
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.S)
_HEAD = re.compile(re.escape(TURN) + r"((?:[^\\\n]|\\.)*)\n", re.S)


def escape(text: str) -> str:
    """Backslashes doubled, and one put into every control string."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int]:
    """The turn as text, and where its own text begins."""
    head = f"{TURN}{escape(role).replace(chr(10), chr(92) + chr(10))}\n"
    return f"{head}{escape(text)}{END}\n", len(head)


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """role, text, start and end of the escaped text, of every turn of a window."""
    at = 0
    while at < len(text):
        head = _HEAD.match(text, at)
        end = text.index(END, head.end())
        yield unescape(head[1]), unescape(text[head.end():end]), head.end(), end
        at = end + len(END) + 1


class _Windows:
    """Cuts one conversation's turns, given in order, into windows."""

    def __init__(self, conv_id: int | None, budget: int, history: int, target_role: str):
        self.conv_id, self.budget, self.history, self.target_role = conv_id, budget, history, target_role
        self.system: tuple[str, str, int] | None = None
        self.seen = self.number = 0
        self.repeated: list[tuple[str, str, int]] = []
        self.fresh: list[tuple[str, str, int]] = []
        self.tokens = 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[tuple]:
        turn = (role, text, tokens)
        if self.fresh and self.tokens + tokens > self.budget:
            yield self._window()
            self._carry_on(tokens)
        if self.seen == 0 and role == "system":
            self.system = turn
        self.seen += 1
        self.fresh.append(turn)
        self.tokens += tokens

    def close(self) -> Iterator[tuple]:
        if self.fresh:
            yield self._window()

    def _carry_on(self, incoming: int) -> None:
        """What the next window repeats: the system turn, then turns from the end of the last window."""
        kept: list[tuple[str, str, int]] = []
        tokens = self.system[2] if self.system else 0
        room = min(self.history, self.budget - tokens - incoming)
        for turn in reversed(self.fresh):
            if turn is self.system or turn[2] > room:
                break
            kept.insert(0, turn)
            room -= turn[2]
        self.repeated = [*([self.system] if self.system else []), *kept]
        self.tokens = sum(t[2] for t in self.repeated)
        self.fresh = []

    def _window(self) -> tuple:
        parts, spans, at = [], [], 0
        for no, (role, text, _) in enumerate([*self.repeated, *self.fresh]):
            shown, start = render(role, text)
            if no >= len(self.repeated) and role == self.target_role:
                spans.append((at + start, at + len(shown) - len(END) - 1))
            parts.append(shown)
            at += len(shown)
        self.number += 1
        return (self.conv_id, self.number - 1, len(self.repeated), len(self.fresh), self.tokens, "".join(parts),
                [{"start": a, "end": b} for a, b in spans])


_WINDOW = ("conv_id bigint, window bigint, n_repeated int, n_new int, n_tokens bigint, text string, "
           "loss array<struct<start:bigint,end:bigint>>")
_WINDOW_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(),
                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]


def _format(budget: int, history: int, target_role: str) -> Callable:
    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Windows | None = None
        names = ["conv_id", "window", "n_repeated", "n_new", "n_tokens", "text", "loss"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(_WINDOW_TYPES)], names)

        for batch in batches:
            rows: list[tuple] = []
            for conv_id, role, text, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state.conv_id != conv_id:
                    if state is not None:
                        rows.extend(state.close())
                    state = _Windows(conv_id, budget, history, target_role)
                rows.extend(state.add(role, text, tokens))
            yield batch_of(rows)
        if state is not None:
            yield batch_of(list(state.close()))

    return form


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, target_role: str = "assistant",
            id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
            text_column: str = "text") -> DataFrame:
    """Windows (conv_id, window, n_repeated, n_new, n_tokens, text, loss spans in code points).

    A turn has as many tokens as words, and four for its marks.  A turn that exceeds the budget
    alone makes a window of its own, whole.  The first turn is kept as the system turn if its role
    is ``system``.  Null roles and texts count as empty, rows without conv_id are one
    conversation; rows of equal turn follow by role and text, repeated rows are repeated turns.
    No rows give no rows.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return (
        turns.select(F.col(id_column).cast("bigint").alias("conv_id"), F.col(turn_column).alias("turn"),
                     F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"), text.alias("text"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text",
                (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) + MARK_TOKENS).cast("bigint").alias("tokens"))
        .mapInArrow(_format(budget, history, target_role), _WINDOW)
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        done = [(r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]) for r in rows]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)], names)

    state: list | None = None
    for batch in batches:
        finished = []
        for conv_id, repeated, text, loss in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or state[0] != conv_id:
                if state is not None:
                    finished.append(state)
                state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for no, (role, said, _, _) in enumerate(parse(text)):
                if no >= repeated:
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
            for span in loss:
                target = unescape(text[span["start"]:span["end"]])
                state[3] += len(target)
                state[4].update(target.encode())
            state[5] += len(text)
        yield batch_of(finished)
    if state is not None:
        yield batch_of([state])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the conversations, from the windows' texts and loss spans alone."""
    return (
        formatted.select("conv_id", "window", "n_repeated", "text", "loss")
        .repartition("conv_id").sortWithinPartitions("conv_id", "window")
        .select("conv_id", "n_repeated", "text", "loss")
        .mapInArrow(_digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                             "loss_sha256 string, formatted_chars bigint")
    )
