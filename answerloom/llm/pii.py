"""Personal data by weak supervision.

Base spans follow fixed patterns.  Beyond them, wide patterns propose further
candidates; six labelers - two regular-expression checks, two gazetteers, two
context checks - vote yes, no or nothing on every candidate, base spans included.
Expectation-maximisation over the counts of all vote combinations in the whole
corpus estimates how reliable every labeler is, and gives each combination the
probability of being personal data.  A logistic regression trained on these
probabilities decides which further candidates become spans.

Votes and a digit count are all the classifier sees, so the training table is the
table of combinations: at most 4 kinds x 3^6 votes x 21 digit counts, whatever
the number of documents.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELERS = 6
CONTEXT = 40
MOST_DIGITS = 20

# Base patterns with possessive digit runs and starts at run borders: the same leftmost
# matches as the plain patterns, in one pass over texts of any length.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Wider candidates.
_SPELT_MAIL = re.compile(
    r" ?(?:\(at\)|\[at\]|\{at\}| at ) ?[A-Za-z0-9-]{1,63} ?(?:\(dot\)|\[dot\]|\{dot\}| dot ) ?[A-Za-z]{2,24}\b")
_PLAIN_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_DOTTED_CARD = re.compile(r"(?<![0-9.])[0-9]{4}[. /][0-9]{4}[. /][0-9]{4}[. /][0-9]{2,7}(?![0-9])")

# Gazetteers.
MAIL_ENDS = frozenset("com org net edu gov io co info biz de fr es it nl uk us eu ch at be pl ru jp cn in br ca au".split())
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38", "62")
PHONE_STARTS = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
                "47", "48", "49", "52", "54", "55", "61", "62", "63", "64", "65", "66", "81", "82", "86", "90", "91")
RESERVED_IP = ("0.", "127.", "169.254.", "192.0.2.", "198.51.100.", "203.0.113.", "255.")
CUES = {
    "email": ("mail", "contact", "reach", "write"),
    "ip": ("ip", "host", "server", "address", "from", "client"),
    "card": ("card", "visa", "credit", "debit", "payment", "mastercard", "amex"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact", "whatsapp"),
}
AGAINST = ("version", "isbn", "order", "invoice", "sku", "section", "serial", "build", "release", "chapter")
_CUE = {k: re.compile(r"\b(?:" + "|".join(v) + r")", re.I) for k, v in CUES.items()}
_AGAINST = re.compile(r"\b(?:" + "|".join(AGAINST) + r")\b", re.I)
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _mail_matches(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part and domain, found from every @ backwards."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.fullmatch(text, start - 1, start):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def base_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """kind, start, end, passes: all matches of the base patterns, failing ones too."""
    if "@" in text:
        for start, end in _mail_matches(text):
            yield "email", start, end, True
    if not _DIGITS.search(text):
        return
    for m in _IP.finditer(text):
        parts = m.group().split(".")
        # Four digits or more are above 255 unless zeros lead.
        yield "ip", m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts)
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        yield "card", m.start(), m.end(), 14 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 10 <= len(_DIGITS.findall(m.group())) <= 15


def _wide(text: str) -> Iterator[tuple[str, int, int]]:
    if "at" in text and "dot" in text:
        for m in _SPELT_MAIL.finditer(text):
            start = m.start()
            while start > 0 and m.start() - start < 64 and _LOCAL.fullmatch(text, start - 1, start):
                start -= 1
            if start < m.start():
                yield "email", start, m.end()
    if _DIGITS.search(text):
        for kind, pattern in (("phone", _PLAIN_PHONE), ("ip", _IP6), ("card", _DOTTED_CARD)):
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end()


def votes(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote of 1, -1 or 0 by each labeler."""
    span = text[start:end]
    digits = "".join(_DIGITS.findall(span))
    lead, after = text[max(0, start - CONTEXT):start], text[end:end + 1]
    if kind == "card":
        valid, known = luhn(digits) and len(digits) >= 13, digits.startswith(CARD_STARTS)
    elif kind == "phone":
        valid, known = 10 <= len(digits) <= 15, digits.startswith(PHONE_STARTS) or len(digits) == 10
    elif kind == "ip":
        parts = span.split(".")
        valid = ":" in span or all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
        known = not span.startswith(RESERVED_IP)
    else:
        host = re.split(r"@|\(at\)|\[at\]|\{at\}| at ", span)[-1]
        valid = not span.startswith((".", "-")) and ".." not in span
        known = re.split(r"[^A-Za-z0-9-]+|dot ", host)[-1].lower() in MAIL_ENDS
    joined = (lead[-1:].isalnum() or after.isalnum()) and kind != "email"
    repeated = len(digits) > 5 and len(set(digits)) <= 2
    return (1 if base else 0, 1 if valid else -1, 1 if known else -1, -1 if repeated else 0,
            1 if _CUE[kind].search(lead) else 0, -1 if joined or _AGAINST.search(lead) else 0)


def candidates(text: str) -> list[tuple[str, int, int, bool, tuple[int, ...], int]]:
    """kind, start, end, base, votes, digit count; base spans of a kind shut out others they overlap."""
    out, taken = [], {k: [] for k in KINDS}
    rest: list[tuple[str, int, int]] = []
    for kind, start, end, passes in base_matches(text):
        if passes:
            taken[kind].append((start, end))
            out.append((kind, start, end, True))
        elif 13 <= sum(c.isdigit() for c in text[start:min(end, start + 64)]) or kind != "card":
            rest.append((kind, start, end))
    rest.extend(_wide(text))
    for kind in KINDS:
        held = taken[kind]
        at, last = 0, -1
        for start, end in sorted((s, e) for k, s, e in rest if k == kind):
            while at < len(held) and held[at][1] <= start:
                at += 1
            if start >= last and not (at < len(held) and held[at][0] < end):
                out.append((kind, start, end, False))
                last = end
    return [(k, s, e, b, votes(text, k, s, e, b),
             min(MOST_DIGITS, sum("0" <= c <= "9" for c in text[s:min(e, s + 80)])))
            for k, s, e, b in out]


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            for kind, _, _, _, vote, digits in candidates(text.as_py() or ""):
                seen[(KINDS.index(kind), sum((v + 1) * 3 ** i for i, v in enumerate(vote)), digits)] += 1
    rows = list(seen.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[i] for k, _ in rows], pa.int32()) for i in range(3)]
        + [pa.array([n for _, n in rows], pa.int64())], ["kind", "vote", "digits", "n"])


def vote_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """How often every combination occurs: kind, vote (base 3), digits, n."""
    return (
        docs.select(F.col(text_column).cast("string").alias("text"))
        .mapInArrow(_patterns, "kind int, vote int, digits int, n bigint")
        .groupBy("kind", "vote", "digits").agg(F.sum("n").alias("n"))
    )


def decoded_votes(code: np.ndarray) -> np.ndarray:
    """Votes -1, 0, 1 of each labeler from their base-3 code."""
    return (code[:, None] // 3 ** np.arange(LABELERS)) % 3 - 1


def estimate(kind: np.ndarray, vote: np.ndarray, n: np.ndarray, rounds: int = 50
             ) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: probability of every combination, labelers' vote tables.

    Labelers vote independently given the truth; each has a table of vote
    probabilities for either truth, shared by the kinds and smoothed by one count, and each
    kind has its own share of true candidates.
    """
    v = decoded_votes(vote) + 1
    p = np.clip(0.5 + (v - 1).sum(axis=1) / (2 * LABELERS + 1), 0.05, 0.95)
    tables = np.zeros((2, LABELERS, 3))
    for _ in range(rounds):
        share = np.array([[1 + (n * p)[kind == k].sum(), 1 + (n * (1 - p))[kind == k].sum()]
                          for k in range(len(KINDS))])
        for truth, weight in ((1, n * p), (0, n * (1 - p))):
            for j in range(LABELERS):
                tables[truth, j] = 1 + np.bincount(v[:, j], weight, 3)
            tables[truth] /= tables[truth].sum(axis=1, keepdims=True)
        odds = np.log(share[kind, 0] / share[kind, 1])
        for j in range(LABELERS):
            odds = odds + np.log(tables[1, j, v[:, j]] / tables[0, j, v[:, j]])
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p, tables


def features(kind: np.ndarray, vote: np.ndarray, digits: np.ndarray) -> np.ndarray:
    v = decoded_votes(vote)
    return np.column_stack([v > 0, v < 0, np.eye(len(KINDS))[kind], digits / MOST_DIGITS,
                            np.ones(len(kind))]).astype(float)


def train(counts: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Weights of the span classifier, by Newton steps on the estimated probabilities.

    Without any candidate all weights are zero and nothing is added to the base.
    """
    width = 2 * LABELERS + len(KINDS) + 2
    if not counts:
        return np.zeros(width)
    kind, vote, digits, n = (np.array(c) for c in zip(*counts))
    target, _ = estimate(kind, vote, n.astype(float))
    x, w = features(kind, vote, digits), np.zeros(width)
    share = n / n.sum() * min(float(n.sum()), 1e6)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (target - p)) - 0.1 * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(width)
        w = w + np.linalg.solve(curve, gradient)
    return w


def trained(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """The classifier for ``docs``; the driver gets the bounded table of combinations."""
    rows = vote_counts(docs, text_column).collect()
    return train(sorted((r["kind"], r["vote"], r["digits"], r["n"]) for r in rows))


def spans_of(text: str, weights: np.ndarray) -> list[tuple[str, int, int, bool]]:
    """kind, start, end, base of the base spans and the accepted candidates, in order."""
    found = candidates(text)
    extra = [c for c in found if not c[3]]
    if extra:
        x = features(np.array([KINDS.index(c[0]) for c in extra]),
                     np.array([sum((v + 1) * 3 ** i for i, v in enumerate(c[4])) for c in extra]),
                     np.array([c[5] for c in extra]))
        accepted = x @ weights > 0
        extra = [c for c, yes in zip(extra, accepted) if yes]
    spans = [c[:4] for c in found if c[3]] + [c[:4] for c in extra]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[tuple[str, int, int, bool]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def _reporter(weights: np.ndarray) -> Callable:
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for text in batch.column(1):
                spans = spans_of(text.as_py() or "", weights)
                base = [s for s in spans if s[3]]
                for i, kind in enumerate(KINDS):
                    columns[i].append(sum(s[0] == kind for s in base))
                columns[4].append(hashlib.sha256(listed(base).encode()).hexdigest())
                columns[5].append(listed(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 *(pa.array(c, pa.string()) for c in columns[4:])],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return report


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, counts of base spans by kind, digest of the base spans, all spans.

    Offsets are code points, ends exclusive.  A null text counts as empty; ids may be
    null or repeat, rows stay as they are.  No rows give no rows.
    """
    weights = trained(docs, text_column)
    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(text_column).cast("string").alias("text")).mapInArrow(
        _reporter(weights),
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string")


def redacted_text(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """Every span replaced by ``<KIND>``; of overlapping spans the earlier one counts and grows."""
    parts, at, open_kind = [], 0, None
    for kind, start, end, _ in spans:
        if open_kind is not None and start < at:
            at = max(at, end)
            continue
        parts += [text[at:start], f"<{kind.upper()}>"]
        at, open_kind = end, kind
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data in the text replaced; the length column follows the text.

    All other columns pass through untouched, null texts stay null.
    """
    weights = trained(docs, text_column)
    at = docs.columns.index(text_column)
    length_at = docs.columns.index(length_column) if length_column in docs.columns else None

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = [None if t is None else redacted_text(t, spans_of(t, weights))
                     for t in columns[at].to_pylist()]
            columns[at] = pa.array(texts, columns[at].type)
            if length_at is not None:
                old = columns[length_at]
                columns[length_at] = pa.array(
                    [o if t is None else len(t) for t, o in zip(texts, old.to_pylist())], old.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(replace, docs.schema)
