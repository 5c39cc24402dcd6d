"""SentencePiece byte-pair encoding by backtracking, and decoding.

The usual encoder merges the best adjacent pair until none is left.  Here a text
is read once from left to right: an Aho-Corasick automaton gives the longest piece
at every position, the encoder takes it when it is compatible with the piece before, and
otherwise tries shorter pieces or goes back.  Two neighbours are compatible when
merging their joined text anew gives back exactly these two pieces.  A bitfield remembers
positions from which no way leads on, so no position is given up twice.

No piece of the model holds a word mark after another character (checked when the model is
loaded), so merges never cross the border before a word mark: chunks are encoded one by
one and common chunks only once.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CHUNKS_HELD, PAIRS_HELD = 100_000, 150_000
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceCodec:
    """Encoder and decoder of one model file; holds bounded caches of chunks and pairs."""

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = len(self.library)
        self.piece = [self.library.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (
            self.library.is_byte(i) or self.library.is_control(i)
            or self.library.is_unknown(i) or self.library.is_unused(i))]
        self.id_of = {self.piece[i]: i for i in plain}
        self.score = {self.piece[i]: self.library.get_score(i) for i in plain}
        self.byte_id = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        characters = {c for p in self.id_of for c in p}
        if any(c not in self.id_of for c in characters) or any(
                not self.library.is_byte(i) for i in self.byte_id):
            raise ValueError("the model lacks single characters or byte pieces")
        if any(p.rstrip(MARK) != p and p.strip(MARK) or MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("the model has pieces across word marks")
        if self.library.encode("a  b ", out_type=str) != self._merged(f"{MARK}a{MARK}{MARK}b{MARK}"):
            raise ValueError("the model changes texts before it encodes them")
        # Pieces that merging cannot build can never stand in a result.
        self.own = {p: i for p, i in self.id_of.items() if self._merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.own.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        # Lists by id: the encoder reads them for every piece it tries.
        self.shorter, self.length = [-1] * size, [len(p) for p in self.piece]
        for p, i in self.own.items():
            self.shorter[i] = next((self.own[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.own), -1)
        self.known = re.compile(f"[{re.escape(''.join(sorted(characters)))}]+")
        self.pairs: dict[int, bool] = {}  # left id * number of pieces + right id
        self.chunks = _Chunks(self)
        self.spelt = [p.replace(MARK, " ").encode() for p in self.piece]
        for b, i in enumerate(self.byte_id):
            self.spelt[i] = bytes([b])
        for i in range(size):
            if self.library.is_control(i) or self.library.is_unknown(i):
                self.spelt[i] = None

    def _merged(self, text: str) -> list[str]:
        """The merging definition, for short texts: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        key = left * len(self.piece) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_HELD:
                self.pairs.clear()
            a, b = self.piece[left], self.piece[right]
            known = self.pairs[key] = self._merged(a + b) == [a, b]
        return known

    def backtracked(self, text: str) -> list[int]:
        """Ids of a text of known characters."""
        out: list[int] = []
        last = -1
        pairs, size = self.pairs, len(self.piece)
        for _, piece in self.automaton.iter_long(text):
            if last >= 0 and not pairs.get(last * size + piece) and not self.compatible(last, piece):
                return self._searched(text, out, piece)
            out.append(piece)
            last = piece
        return out

    def _searched(self, text: str, out: list[int], piece: int) -> list[int]:
        """The same where taking the longest piece everywhere does not succeed: ``piece`` does not fit behind ``out``."""
        n, size = len(text), len(self.piece)
        length, shorter, pairs = self.length, self.shorter, self.pairs
        longest = [-1] * n
        for end, found in self.automaton.iter(text):
            longest[end + 1 - length[found]] = found  # ends rise, so the longest comes last
        failed = None  # a bit for every position, made when one fails
        at, last = sum(map(length.__getitem__, out)), out[-1]
        while True:
            end = at + length[piece]
            if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                fits = last < 0 or pairs.get(last * size + piece)
                if fits is None:
                    fits = self.compatible(last, piece)
                if fits:
                    out.append(piece)
                    if end == n:
                        return out
                    at, last, piece = end, piece, longest[end]
                    continue
            if shorter[piece] >= 0:
                piece = shorter[piece]
            else:
                if failed is None:
                    failed = bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                if not out:
                    raise ValueError("no sequence of compatible pieces")
                piece = out.pop()
                last = out[-1] if out else -1
                at -= length[piece]

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of one chunk as native 32-bit numbers; characters outside the model become bytes."""
        if self.known.fullmatch(chunk):
            return array("I", self.backtracked(chunk)).tobytes()
        out: list[int] = []
        at = 0
        for run in self.known.finditer(chunk):
            out.extend(self.byte_id[b] for b in chunk[at:run.start()].encode())
            out.extend(self.backtracked(run.group()))
            at = run.end()
        out.extend(self.byte_id[b] for b in chunk[at:].encode())
        return array("I", out).tobytes()

    def encode(self, text: str) -> array:
        """Ids of ``text`` between the begin and the end id."""
        out = array("I", [self.begin])
        if text:
            chunks = _CHUNK.findall(MARK + text.replace(" ", MARK))
            out.frombytes(b"".join(map(self.chunks.__getitem__, chunks)))
        out.append(self.end)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; begin and end ids give nothing, a leading mark neither.

        Id lists that no text encodes to (control ids inside, broken characters) are left
        to the library's decoder.
        """
        first = 1 if ids[:1] == [self.begin] else 0
        last = len(ids) - (1 if ids[first:][-1:] == [self.end] else 0)
        try:
            text = b"".join(map(self.spelt.__getitem__, ids[first:last])).decode()
        except (TypeError, UnicodeDecodeError):
            return self.library.decode(ids)
        return text[1:] if first < last and self.piece[ids[first]][0] == MARK else text


class _Chunks(dict):
    """chunk -> ids, encoded on first use; short chunks are held in two generations.

    A full generation becomes the old one; chunks still in use move back from it.
    """

    def __init__(self, coder: PieceCodec):
        super().__init__()
        self.coder = coder
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.coder.chunk_ids(chunk)
        if len(chunk) <= 64:
            if len(self) >= CHUNKS_HELD:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_LOADED: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """One codec per model file and Python worker."""
    if model_file not in _LOADED:
        _LOADED[model_file] = PieceCodec(model_file)
    return _LOADED[model_file]


def _little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def _encoder(model_file: str, with_ids: bool) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file)
        for batch in batches:
            rows: list[list] = [[] for _ in range(4)]
            for text in batch.column(1):
                ids = coder.encode(text.as_py() or "")
                rows[0].append(len(ids))
                rows[1].append(hashlib.sha256(_little_endian(ids)).hexdigest())
                rows[2].append(hashlib.sha256(coder.decode(ids.tolist()).encode()).hexdigest())
                if with_ids:
                    rows[3].append(np.frombuffer(ids, np.int32))
            columns = [batch.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()),
                       pa.array(rows[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = [0]
                for n in rows[0]:
                    offsets.append(offsets[-1] + n)
                flat = pa.array(np.concatenate([np.zeros(0, np.int32), *rows[3]]), pa.int32())
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return encode


def encoded(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            model_file: str | None = None, with_ids: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens, digests of the ids and of the decoded text, and the ids.

    Begin and end ids are included.  A null text counts as empty (two ids, decoded
    to nothing); ids may be null or repeat.  No rows give no rows.  The model file must
    lie at the same path on every machine.
    """
    path = os.path.abspath(model_file or default_model())
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(text_column).cast("string").alias("text")).mapInArrow(
        _encoder(path, with_ids), schema + (", ids array<int>" if with_ids else ""))


def _decoder(model_file: str) -> Callable:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file)
        for batch in batches:
            texts = [None if x is None else coder.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    return decode


def decoded(rows: DataFrame, id_column: str = "doc_id", ids_column: str = "ids",
            model_file: str | None = None) -> DataFrame:
    """Texts (doc_id, text) of id lists; null lists stay null."""
    path = os.path.abspath(model_file or default_model())
    return rows.select(F.col(id_column).cast("bigint").alias("doc_id"),
                       F.col(ids_column).cast("array<int>").alias("ids")).mapInArrow(
        _decoder(path), "doc_id bigint, text string")
