"""Declared table schemas; readers never infer."""

from __future__ import annotations

from pyspark.sql import types as T

ARTICLE = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("document_id", T.LongType()),
])

ANSWERS = T.StructType([
    T.StructField("text", T.ArrayType(T.StringType())),
    T.StructField("answer_start", T.ArrayType(T.IntegerType())),
])

QA_NESTED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("context", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("document_id", T.LongType()),
    T.StructField("answers", ANSWERS),
])

PASSAGE = T.StructType([
    T.StructField("article_id", T.LongType()),
    T.StructField("paragraph_id", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
])

EMBEDDED_PASSAGE = T.StructType([
    T.StructField("passage_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

SPARSE_RESULT = T.StructType([
    T.StructField("question_id", T.LongType()),
    T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
])

METRIC = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("epoch", T.IntegerType()),
    T.StructField("step", T.LongType()),
    T.StructField("split", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
