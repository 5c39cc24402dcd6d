"""Licence families of documents, paragraph by paragraph, in DataFrame operations only.

A paragraph ends before an empty line, a line of marks only or an SPDX tag, and at a line whose last
character ends a sentence; other line breaks are soft, so a notice wrapped over several lines, also behind comment
marks, is one paragraph.  Paragraphs are cut into word pairs.  A sparse multinomial logistic regression, trained on
licence notices and on paragraphs of the corpus, gives every paragraph the
probability of each family and of "unknown"; a temperature fitted on rows kept aside calibrates
it.  A prediction counts only if the paragraph also holds at least half of the word pairs
of one notice of that family, and two of them: a notice of two pairs must be there as a whole.

Scoring is a join with the table of weighted word pairs, whose size the notices bound, and a sum
by paragraph; paragraphs without any weighted pair are unknown and never move.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm.literals import table
from answerloom.operators.stored import written_once

#: Usual wording of licence notices.
NOTICES = {
    "agpl-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License "
        "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ],
}
#: Ordinary sentences with words of licences.
PLAIN = [
    "He lost his driving license and had to apply for a new one.", "The license plate was covered with mud.",
    "You need a license to fish in this lake.", "The restaurant got its liquor license last year.",
    "The team released the new version of the software on Monday.", "Public transport is free of charge on Sundays.",
    "The public library is open to any person.", "The general public was not allowed to use the road.",
    "All rights of way are marked on the map.", "The work is subject to the terms of the contract.",
    "Under the terms of the agreement the two parties share the costs.", "A copy of this letter was found.",
    "In this version of the story the king is the author.", "It is distributed on a daily basis.",
    "The foundation gave free software to schools.", "No part of this story is true.",
]
UNKNOWN = "unknown"
CORPUS_SAMPLE, SAMPLE_DOCUMENTS = 2000, 400
COMMON = 0.01
# A line break behind the end of a sentence, or one in front of a line without letters and digits or of an SPDX tag.
PARAGRAPH_END = r"(?<=[.!?:;])[ \t\r]*\n|\n(?=[^\nA-Za-z0-9\x80-\x{10FFFF}]*(?:\n|$|SPDX-))"
SURE, ALIKE, LEAST_PAIRS = 0.5, 0.5, 2


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def pairs_of(text: str) -> list[str]:
    """Distinct neighbouring word pairs; a paragraph of one word is a pair with nothing."""
    words = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def word_pairs(text: Column) -> Column:
    """The same as a column: word pairs of a paragraph, each once.

    Only A-Z are lower-cased, so letters outside ASCII separate words like punctuation.
    """
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lowered, "[^a-z0-9]+"), lambda w: w != "")
    return F.array_distinct(F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)))


def split_paragraphs(text: Column) -> Column:
    """Paragraphs of a text; lines end in a line feed, with or without a carriage return."""
    return F.split(text, PARAGRAPH_END)


def _variants(notice: str) -> list[str]:
    """The notice, parts of it, and it among other words."""
    words = notice.split(" ")
    half = max(3, len(words) // 2)
    return [notice, " ".join(words[:half]), " ".join(words[-half:]), " ".join(words[:-1]),
            f"Copyright 2020 the authors. {notice}"]


def training_rows(spark: SparkSession, docs: DataFrame, text_column: str) -> tuple[list[tuple], list[str], list[str]]:
    """(label, weight, pairs, kept aside) rows, classes, vocabulary.

    The corpus gives at most 2,000 paragraphs of the 400 different texts with the smallest md5; those
    that hold half of a notice are not used as examples of "unknown".  Pairs found in more than one
    in a hundred of them say nothing about licences and leave the vocabulary.
    """
    texts = docs.select(F.col(text_column).cast("string").alias("text")).where(F.col("text").isNotNull()).select(
        "text", F.md5("text").alias("mark"))
    # Thinned by the same hash first, so copies of few texts meet, and each text counts once.
    share = min(1.0, 2 * SAMPLE_DOCUMENTS / max(1, texts.select(F.approx_count_distinct("mark")).first()[0]))
    thin = texts.where(F.conv(F.substring("mark", 1, 8), 16, 10).cast("bigint") <= int(share * (1 << 32)))
    chosen = thin.groupBy("mark").agg(F.first("text").alias("text")).orderBy("mark").limit(SAMPLE_DOCUMENTS)
    lines = chosen.select(F.explode(split_paragraphs(F.col("text"))).alias("line")).where("trim(line) <> ''").distinct()
    plain = [r["pairs"] for r in lines.orderBy(F.md5("line")).limit(CORPUS_SAMPLE)
             .select(word_pairs(F.col("line")).alias("pairs")).collect()]
    held = [set(pairs_of(n)) for notices in NOTICES.values() for n in notices]
    plain = [p for p in plain if not any(len(h & set(p)) >= max(LEAST_PAIRS, ALIKE * len(h)) for h in held)]
    plain = [*plain, *(pairs_of(s) for s in PLAIN)]
    vocabulary = {p for h in held for p in h} | {p for s in PLAIN for p in pairs_of(s)}
    often: dict[str, int] = {}
    for pairs in plain:
        for p in set(pairs) & vocabulary:
            often[p] = often.get(p, 0) + 1
    vocabulary = sorted(p for p in vocabulary if often.get(p, 0) <= max(3, COMMON * len(plain)))
    classes = [UNKNOWN, *NOTICES]
    rows = [(0, 20.0 if i >= len(plain) - len(PLAIN) else 1.0, p, i % 5 == 0 and i < len(plain) - len(PLAIN))
            for i, p in enumerate(plain)]
    for no, family in enumerate(classes[1:], 1):
        for notice in NOTICES[family]:
            rows += [(no, 20.0, pairs_of(v), k == 4) for k, v in enumerate(_variants(notice))
                     if len(pairs_of(v)) >= LEAST_PAIRS]
    return rows, classes, vocabulary


def logits_of(pairs: list[str], weights: dict[str, list[float]], intercepts: list[float]) -> list[float]:
    out = list(intercepts)
    for p in set(pairs):
        for k, w in enumerate(weights.get(p, ())):
            out[k] += w
    return out


def temperature(rows: list[tuple[int, list[float]]]) -> float:
    """The temperature with the smallest log loss on (class, logits) rows not trained on."""
    def loss(t: float) -> float:
        total = 0.0
        for label, z in rows:
            top = max(z)
            total += math.log(sum(math.exp((x - top) / t) for x in z)) - (z[label] - top) / t
        return total

    return min((0.25 * 1.25 ** i for i in range(20)), key=loss)


def trained(spark: SparkSession, docs: DataFrame, text_column: str
            ) -> tuple[list[str], dict[str, list[float]], list[float], float]:
    """Classes, weights by word pair, intercepts and temperature."""
    rows, classes, vocabulary = training_rows(spark, docs, text_column)
    counter = CountVectorizerModel.from_vocabulary(vocabulary, "pairs", "features")
    counter.setBinary(True)
    seen = table(spark, [(float(r[0]), r[1], r[2]) for r in rows if not r[3]],
                 "label double, weight double, pairs array<string>")
    model = LogisticRegression(family="multinomial", regParam=0.0005, maxIter=60,
                               weightCol="weight").fit(counter.transform(seen))
    matrix = model.coefficientMatrix.toArray()
    weights = {p: [float(x) for x in matrix[:, j]] for j, p in enumerate(vocabulary) if matrix[:, j].any()}
    intercepts = [float(x) for x in model.interceptVector.toArray()]
    aside = [(r[0], logits_of(r[2], weights, intercepts)) for r in rows if r[3]]
    return classes, weights, intercepts, temperature(aside)


def scored_paragraphs(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of all rows, and row, paragraph, family, probability, similarity of confirmed paragraphs.

    A row key is written together with the weighted word pairs.  Paragraph 0 stands for the row itself
    and holds one pair without weights, so rows without licences are in the stored table as well.
    """
    spark = docs.sparkSession
    classes, weights, intercepts, heat = trained(spark, docs, text_column)
    notices = [(family, no, n, pairs_of(n)) for family, ns in NOTICES.items() for no, n in enumerate(ns)]
    compared = [(p, f"{family}/{no}", len(pairs)) for family, no, _, pairs in notices for p in pairs]
    known = sorted({*weights, *(p for p, _, _ in compared)})
    nothing = [0.0] * len(classes)
    sheet = table(spark, [("", nothing, []), *(
        (p, weights.get(p, nothing), [{"notice": n, "size": s} for q, n, s in compared if q == p]) for p in known)],
                  "pair string, w array<double>, notices array<struct<notice:string,size:int>>")
    parts = F.concat(F.array(F.lit("")), F.coalesce(split_paragraphs(F.col("text")), F.array()))
    paired = F.when(F.col("paragraph") == 0, F.array(F.lit(""))).otherwise(word_pairs(F.col("line")))
    stored = written_once(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("doc_id"),
                    F.col(text_column).cast("string").alias("text"))
        .select("row", "doc_id", F.posexplode(parts).alias("paragraph", "line"))
        .select("row", "doc_id", "paragraph", F.explode(paired).alias("pair"))
        .join(F.broadcast(sheet), "pair"))
    hits = stored.where("paragraph > 0")
    sums = hits.groupBy("row", "paragraph").agg(
        *[F.sum(F.col("w")[k]).alias(f"z{k}") for k in range(len(classes))])
    z = F.array(*[(F.col(f"z{k}") + intercepts[k]) / heat for k in range(len(classes))])
    names = F.array(*[F.lit(c) for c in classes])
    guessed = (
        sums.select("row", "paragraph", z.alias("z"))
        .select("row", "paragraph", "z", F.array_max("z").alias("top"))
        .select("row", "paragraph", names[F.array_position("z", F.col("top")).cast("int") - 1].alias("family"),
                (1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("probability"))
        .where((F.col("family") != UNKNOWN) & (F.col("probability") >= SURE))
    )
    alike = (
        hits.select("row", "paragraph", F.inline("notices"))
        .groupBy("row", "paragraph", "notice").agg((F.count("*") / F.max("size")).alias("share"), F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_PAIRS)
        .groupBy("row", "paragraph", F.substring_index("notice", "/", 1).alias("family"))
        .agg(F.max("share").alias("similarity")).where(F.col("similarity") >= ALIKE)
    )
    return stored.where("paragraph = 0").select("row", "doc_id"), guessed.join(alike, ["row", "paragraph", "family"])


def licence_paragraphs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, paragraph (from 0), family, probability, similarity of all confirmed paragraphs."""
    rows, found = scored_paragraphs(docs, id_column, text_column)
    return rows.join(found, "row").select("doc_id", (F.col("paragraph") - 1).alias("paragraph"), "family", "probability",
                                          "similarity")


def scan_licences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, licences (families by name, comma-joined), n_paragraphs, probability, similarity.

    Probability and similarity are the best among the row's confirmed paragraphs, null
    without any; licences is then ``unknown``.  Null and blank texts are unknown.  Every
    row is scanned by itself, also when rows repeat a doc_id or have none.  No rows give no rows.
    """
    rows, confirmed = scored_paragraphs(docs, id_column, text_column)
    found = confirmed.groupBy("row").agg(
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("licences"),
        F.count("*").alias("n_paragraphs"), F.max("probability").alias("probability"),
        F.max("similarity").alias("similarity"))
    return rows.join(found, "row", "left").select(
        "doc_id", F.coalesce("licences", F.lit(UNKNOWN)).alias("licences"),
        F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"), "probability", "similarity")
