import json

import pytest

from answerloom.sources import pieces, tables

NASTY = ['a}b', '{"x": {', '\\', '\\"}', '"', '}}{{', '', 'line\n}\r\nline', '한글 } 글', '","7": {"text": "no"}', '\\\\"}{']


def dump(n):
    return {str(i): {"text": NASTY[i % len(NASTY)] * (1 + i % 5), "title": NASTY[(i * 7) % len(NASTY)] or None,
                     "document_id": i, "extra": {"a}": {"b": [1, {"c": "}"}]}, "q\"": []}} for i in range(n)}


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in old:
        spark.conf.set(key, "1000")
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_one_object_in_many_ranges(spark, rows, tmp_path, small_ranges, indent, ascii_only):
    want = dump(150)
    text = json.dumps(want, indent=indent, ensure_ascii=ascii_only)
    (tmp_path / "d.json").write_text(text, encoding="utf-8", newline="")
    cut = pieces.dump_pieces(spark, str(tmp_path))
    assert cut.select("block").distinct().count() >= len(text) // 1100 > 10
    got = rows(pieces.read_dump_splits(spark, str(tmp_path)), "row_key", "article_id", "title", "text")
    assert got == sorted(((k, a["document_id"], a["title"], a["text"]) for k, a in want.items()), key=repr)
    assert got == rows(tables.read_dump(spark, str(tmp_path)), "row_key", "article_id", "title", "text")


def test_files_objects_and_ends(spark, rows, tmp_path, small_ranges):
    (tmp_path / "a.json").write_text('{"1": {"text": "x", "document_id": 1}}\n{"2": {"text": "y}", "document_id": 2}}\n')
    (tmp_path / "b.json").write_text('{}')
    (tmp_path / "c.json").write_text('')
    (tmp_path / "d.json").write_text(' { "3" : {} , "4" : { "text" : "cut')
    got = rows(pieces.read_dump_splits(spark, str(tmp_path)), "row_key", "article_id", "title", "text")
    assert got == [("1", 1, None, "x"), ("2", 2, None, "y}"), ("3", None, None, None)]
