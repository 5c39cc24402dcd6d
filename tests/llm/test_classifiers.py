"""Quality, toxicity and licences: held-out accuracy, brute force, odd rows."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.llm import licences, quality, toxicity
from answerloom.llm.words import WordHashes, shingle_hashes, words_of

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, label int, z0 int"
LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=500):
    draw = random.Random(6)
    words = [f"{draw.choice('bcdfgklmnprst')}{draw.choice('aeiou')}{draw.choice('lnrst')}{i % 7}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        good, toxic = draw.random() < 0.8, draw.random() < 0.2
        text = draw.choices(words, k=draw.randint(30, 150)) if good else (
            [draw.choice(words)] * draw.randint(30, 90) if i % 2 else
            [f"{w}{draw.choice(['###', '$$$'])}" for w in draw.choices(words, k=60)])
        if toxic:
            for w in draw.sample(["idiot", "moron", "scum", "pathetic", "worthless"], 3):
                text.insert(draw.randrange(len(text)), w + draw.choice(["", ",", "."]))
        docs.append((i, " ".join(text), "en", "s", 0, "x", 1, 2))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    extra = [(None, None, None, None, 0, "x", 1, 2), (9000, "", "en", "s", 0, "x", 1, 2), (1, "again here", "en", "s", 0, "x", 1, 2)]
    return (spark.createDataFrame([*docs, *extra], DOCS),
            spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (77777, 1, 0)], LABELS), dict((r[0], r) for r in labels))


def test_quality_on_the_held_out_fold(tables):
    docs, labels, truth = tables
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    right = total = 0
    for r in rows:
        i = r["doc_id"]
        assert r["held_out"] == (zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"] and i in truth and i != 1:
            right += r["predicted"] == truth[i][1]
            total += 1
    assert total > 60 and right / total > 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] for r in rows)


def test_quality_reads_no_labels_of_fold_0(tables):
    docs, labels, _ = tables
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) quality", "toxic")
    scores = [{(r["doc_id"], r["score"]) for r in quality.score_quality(docs, x).collect()} for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_without_labels(spark, tables):
    docs, labels, _ = tables
    none = labels.limit(0)
    assert {r["score"] for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    assert {r["p_toxic"] for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_temperature_softens_overconfident_scores():
    draw = np.random.Generator(np.random.PCG64(2))
    x = draw.normal(size=(800, 4))
    y = (x[:, 0] + draw.normal(0, 1.5, 800) > 0).astype(float)
    network = quality.Network(x[:200], y[:200])
    network.calibrate(x[200:500], y[200:500])
    assert network.temperature > 1

    def loss(t):
        z = network.logit(x[500:]) / t
        return np.logaddexp(0, np.where(y[500:] == 1, -z, z)).mean()

    assert loss(network.temperature) < loss(1.0)


def test_word_vectors_are_sums_over_all_texts(spark):
    texts = ["a b c a", "B c", None, ""]
    index, hashes = quality.index_vectors(), WordHashes()
    want = np.zeros((quality.ROWS, quality.DIMENSIONS))
    for t in texts:
        rows = quality.rows_of(hashes.of(words_of((t or "").encode())))
        for i, r in enumerate(rows):
            for j in range(max(0, i - quality.REACH), min(len(rows), i + quality.REACH + 1)):
                want[r] += index[rows[j]] if j != i else 0
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    slices = frame.mapInArrow(quality._sum_company, "slice int, sums binary").collect()
    got = np.zeros((quality.SLICES, quality.ROWS // quality.SLICES * quality.DIMENSIONS))
    for r in slices:
        got[r["slice"]] += np.frombuffer(r["sums"], np.int64)
    assert (got.reshape(want.shape) == want).all()


def test_toxicity_chain(tables):
    docs, labels, truth = tables
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    right = [r["predicted"] == truth[r["doc_id"]][2] for r in rows if r["doc_id"] in truth and r["doc_id"] != 1]
    assert np.mean(right) > 0.97
    inner = [r["p_dehumanising"] > 0.5 for r in rows if r["doc_id"] in truth and r["predicted"] == 1]
    assert 0.3 < np.mean(inner) < 0.95


def test_later_models_learn_from_predictions_made_aside():
    draw = np.random.Generator(np.random.PCG64(3))
    first = draw.random(900) < 0.4
    documents = [np.array(sorted({int(f), 2 + int(draw.integers(0, 40))})) for f in first]
    labels = np.column_stack([first, first]).astype(int)
    chain = toxicity.fit_chain(documents, np.arange(900) % 3, labels, ["one", "two"])
    p = chain.probabilities(documents)
    assert ((p > 0.5) == labels).mean() > 0.99 and chain.models[1].dense[0] > 0
    assert chain.probabilities([np.zeros(0, np.int64)]).shape == (1, 2)


LICENSED = [
    (1, "Some words here\nReleased under the MIT License.\nmore words"),
    (2, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0."),
    (3, "This work is licensed under the GNU General Public License, version 3."),
    (4, "He lost his driving license and had to apply for a new one."),
    (5, "The GNU is an animal. Released on Monday under the bridge."), (6, ""), (7, None), (None, "the MIT campus"),
    (8, "Permission is hereby granted, free of charge, to any person obtaining a copy of this thing"),
    (9, "x " * 30000 + "\nSPDX-License-Identifier: MPL-2.0"),
]


def plain_paragraphs(text):
    """Lines put together while their break is soft."""
    lines, out = (text or "").split("\n"), [""]
    for line, after in zip(lines, [*lines[1:], None]):
        out[-1] += line
        bare = re.sub(r"[^A-Za-z0-9\x80-\U0010FFFF]", "", after or "")
        if line.rstrip(" \t\r")[-1:] in tuple(".!?:;") or after is not None and (
                not bare or re.match(r"[^A-Za-z0-9\x80-\U0010FFFF]*SPDX-", after)):
            out.append("")
        else:
            out[-1] += "\n"
    return out


def test_paragraph_borders(spark):
    texts = ["a\nb.\nc d\n\n e\n// *\n// f\n// g\nSPDX-License-Identifier: MIT\nx", "", "one", "\n\n", "é!\r\nß\nç", "a \n"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r["p"] for r in frame.select("i", licences.split_paragraphs(F.col("text")).alias("p")).collect()}
    words = lambda parts: [w for w in (re.findall(r"\w+", p) for p in parts) if w]
    assert words(got[0]) == [["a", "b"], ["c", "d"], ["e"], ["f", "g"], ["SPDX", "License", "Identifier", "MIT", "x"]]
    for i, text in enumerate(texts):
        assert words(got[i]) == words(plain_paragraphs(text))


def test_licences(spark, tables):
    rows = [(i, t, "en", "s", 0, "x", 1, 2) for i, t in LICENSED]
    frame = spark.createDataFrame(rows, DOCS).unionByName(tables[0].where("doc_id between 10 and 60"))
    classes, weights, intercepts, heat = licences.trained(spark, frame, "text")
    got = {r["doc_id"]: r for r in licences.scan_licences(frame).collect()}
    for i, text in LICENSED:
        want, best = set(), []
        for line in plain_paragraphs(text):
            pairs = licences.pairs_of(line)
            z = [x / heat for x in licences.logits_of(pairs, weights, intercepts)]
            p = np.exp(np.array(z) - max(z)) / np.exp(np.array(z) - max(z)).sum()
            family = classes[int(np.argmax(z))]
            alike = max((len(set(licences.pairs_of(n)) & set(pairs)) / len(set(licences.pairs_of(n)))
                         for n in licences.NOTICES.get(family, [])), default=0)
            if family != licences.UNKNOWN and p.max() >= licences.SURE and alike >= licences.ALIKE:
                want.add(family)
                best.append(p.max())
        assert got[i]["licences"] == (",".join(sorted(want)) or "unknown"), text
        assert got[i]["n_paragraphs"] == len(best)
        assert got[i]["probability"] is None if not best else abs(got[i]["probability"] - max(best)) < 1e-9
    assert {i: got[i]["licences"] for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, None)} == {
        1: "mit", 2: "apache-2.0,cc-by-nc", 3: "gpl", 4: "unknown", 5: "unknown", 6: "unknown", 7: "unknown", 8: "mit",
        9: "mpl-2.0", None: "unknown"}
    assert {got[i]["licences"] for i in range(10, 61)} == {"unknown"}
    assert licences.scan_licences(frame.limit(0)).count() == 0


# Usual wording of licence notices, wrapped.
WRAPPED_MIT = ("Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated\n"
               "documentation files (the \"Software\"), to deal\nin the Software without restriction, including\nwithout limitation")
WRAPPED_BSD = ("# Redistribution and use in source and\n# binary forms, with or without modification, are\n# permitted provided that "
               "the following conditions\n# are met:")


def test_wrapped_repeated_and_nameless_notices(spark, tables):
    part = "Permission is hereby granted, free of"
    rows = [(1, WRAPPED_MIT), (2, f"code\n#\n{WRAPPED_BSD}\n# more"), (3, part), (3, part), (3, part), (3, part), (None, "nothing at all"),
            (None, "Released under the MIT License."), (None, None), (4, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: ISC")]
    frame = spark.createDataFrame([(i, t, "en", "s", 0, "x", 1, 2) for i, t in rows], DOCS).unionByName(
        tables[0].where("doc_id between 10 and 60"))
    got = [(r["doc_id"], r["licences"], r["similarity"]) for r in licences.scan_licences(frame).collect()]
    assert len(got) == frame.count() and all(s is None or 0.5 <= s <= 1 for _, _, s in got)
    found = sorted((repr(i), f) for i, f, _ in got if i is None or i < 10)
    assert found == sorted([("1", "mit"), ("2", "bsd"), *[("3", "unknown")] * 4, ("None", "unknown"), ("None", "mit"), ("None", "unknown"),
                            ("4", "isc,mit")])
    held = licences.licence_paragraphs(frame)
    assert {r["paragraph"] for r in held.where("doc_id = 4").collect()} == {0, 1}


def test_all_rights_reserved_is_a_notice(spark, tables):
    lines = ["All rights reserved.", "Some words before.\nALL RIGHTS RESERVED\nand after.", "Some rights reserved.",
             "All rights of way are marked on the map.", "He has all rights and duties of a member."]
    frame = spark.createDataFrame([(i, t, "en", "s", 0, "x", 1, 2) for i, t in enumerate(lines)], DOCS).unionByName(
        tables[0].where("doc_id between 10 and 60"))
    got = {r["doc_id"]: r["licences"] for r in licences.scan_licences(frame).collect()}
    assert [got[i] for i in range(5)] == ["proprietary", "proprietary", "unknown", "unknown", "unknown"]
    rows, classes, _ = licences.training_rows(spark, frame, "text")
    assert not any(r[0] == 0 and "rights reserved" in r[2] and "all rights" in r[2] for r in rows)


def test_licence_plan_has_no_python(spark, tables, capsys):
    licences.scan_licences(tables[0].limit(20)).explain()
    assert not any(word in capsys.readouterr().out for word in ("Python", "Arrow", "Pandas"))


def test_shingle_hashes_tell_short_texts_apart():
    hashes = WordHashes(limit=2)
    of = lambda t: shingle_hashes(hashes.of(words_of(t)), 5)
    assert len(of(b"a b c d e f")) == 2 and len(of(b"a b")) == 1 and len(of(None)) == 0
    assert of(b"A\tb")[0] == of(b" a b ")[0] and of(b"a b")[0] != of(b"b a")[0] and of(b"a")[0] != of(b"a a")[0]
