import json
import os

import pytest

from answerloom import schemas
from answerloom.operators.retrieval import prediction_lines
from answerloom.sources import tables


def test_dump_and_lines(spark, rows, tmp_path):
    dump = {"0": {"text": "한글\n\"x\"", "title": "t", "document_id": 7, "extra": [1]},
            "1": {"text": "y", "title": "u", "document_id": 8}}
    (tmp_path / "a.json").write_text(json.dumps(dump), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps({"5": {"text": "z", "document_id": 9}}))
    got = tables.read_dump(spark, str(tmp_path / "*.json"))
    want = [("0", 7, "t", "한글\n\"x\""), ("1", 8, "u", "y"), ("5", 9, None, "z")]
    assert rows(got, "row_key", "article_id", "title", "text") == want
    tables.write_article_lines(got, str(tmp_path / "lines"))
    back = tables.read_article_lines(spark, str(tmp_path / "lines"))
    assert rows(back, "article_id", "title", "text") == [w[1:] for w in want]


def test_tables_and_splits(spark, rows, tmp_path):
    frame = spark.createDataFrame([(1, 0, "t", "x")],
                                  "article_id int, paragraph_id int, title string, text string")
    tables.write_table(frame, str(tmp_path / "p"))
    assert rows(tables.read_table(spark, str(tmp_path / "p"), schemas.PASSAGE)) == [(1, 0, "t", "x")]
    with pytest.raises(ValueError, match="embedding"):
        tables.read_table(spark, str(tmp_path / "p"), schemas.EMBEDDED_PASSAGE)
    path = str(tmp_path / "s")
    tables.write_splits({"train": frame, "test": frame.where("false"),
                         "validation": frame.withColumn("text", frame.title)}, path)
    assert rows(tables.read_split(spark, path, "validation"), "text") == [("t",)]
    plan = tables.read_split(spark, path, "train")._jdf.queryExecution().executedPlan().toString()
    assert "(split" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_predictions_stay_utf8(spark, tmp_path):
    frame = spark.createDataFrame([(3, "답 \"x\"")], "id long, answer string")
    tables.write_lines(prediction_lines(frame), str(tmp_path / "out"))
    text = "".join((tmp_path / "out" / f).read_text(encoding="utf-8")
                   for f in os.listdir(tmp_path / "out") if f.startswith("part"))
    assert "답" in text and json.loads(text) == {"id": "3", "answer": "답 \"x\""}
