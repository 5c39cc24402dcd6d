"""Vectors for passages and questions from a pluggable batch encoder."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.functions.text import words

DIMENSIONS = 256
COUNTED_TEXTS = 1000
ENCODER_BATCH = 64


def embed(rows: DataFrame, id_col: str, text_col: str,
          encoder: Callable[[list[str]], np.ndarray], batch_size: int = ENCODER_BATCH) -> DataFrame:
    """(id, vector array<float>) from ``encoder(list of texts) -> 2-d array``.

    The encoder is sent to the executors once, as a broadcast, unpacked once per
    task and called with ``batch_size`` texts at a time.
    """
    shared = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(encoder))

    def run(batches):
        encode = pickle.loads(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                part = batch.slice(at, batch_size)
                matrix = np.asarray(encode(part.column(1).to_pylist()), dtype=np.float32)
                yield _with_vectors(id_col, part.column(0), matrix)

    source = rows.select(id_col, text_col)
    return source.mapInArrow(run, f"{id_col} bigint, vector array<float>")


def _with_vectors(name: str, ids: pa.Array, matrix: np.ndarray) -> pa.RecordBatch:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))
    return pa.RecordBatch.from_arrays([ids, vectors], [name, "vector"])


def word_slots(words: pa.Array, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Vector slot of every word: leading 32 bits of its MD5, modulo the size; equal words are hashed once."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    digests = b"".join([hashlib.md5(w, usedforsecurity=False).digest() for w in distinct])
    return (np.frombuffer(digests, ">u4")[::4].astype(np.int64) % dimensions)[coded.indices.to_numpy()]


def word_vectors(rows: DataFrame, id_col: str, words_col: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """Hashed bag of the words in a list column, unit length, zero for no words or no list.

    The worker hashes the distinct words of an Arrow batch and counts slots, one ``bincount``
    for COUNTED_TEXTS of its rows, which bounds the dense counts it holds.
    """
    def run(batches):
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes)])
            slots = word_slots(batch.column(1).flatten(), dimensions)
            for at in range(0, batch.num_rows, COUNTED_TEXTS):
                n = min(COUNTED_TEXTS, batch.num_rows - at)
                row = np.repeat(np.arange(n), sizes[at:at + n])
                counts = np.bincount(row * dimensions + slots[ends[at]:ends[at + n]], minlength=n * dimensions)
                matrix = counts.reshape(n, dimensions).astype(np.float64)
                length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
                matrix = matrix / np.where(length > 0, length, 1.0)
                yield _with_vectors(id_col, batch.column(0).slice(at, n), matrix.astype(np.float32))

    none = F.expr("cast(array() as array<string>)")
    return rows.select(id_col, F.coalesce(words_col, none).alias("words")).mapInArrow(
        run, f"{id_col} bigint, vector array<float>")


def hashed_vectors(rows: DataFrame, id_col: str, text_col: str,
                   dimensions: int = DIMENSIONS) -> DataFrame:
    """Default encoder: hashed bag of words, unit length, zero for wordless text."""
    return word_vectors(rows.select(id_col, words(F.col(text_col)).alias("words")), id_col, "words", dimensions)
