"""Quoted CSV and JSON arrays over many byte ranges against the multi-line readers."""

import json
import random

import pytest

from spanforge.sources.ranges import CsvCutter, pieces, read_csv_ranges, read_json_arrays
from spanforge.sources.records import EXPORT_SCHEMA, WORD_LEVEL_SCHEMA


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def cell(r):
    return "".join(r.choice(["a", "b c", '"', '""', ",", "\n", "\n\n", "É", "x" * 40, " ", "'", "\\", "{", "}"]) for _ in range(r.randint(0, 12)))


def csv_text(rows, end, quote_all):
    def out(v):
        return '"' + v.replace('"', '""') + '"' if quote_all or any(c in v for c in '",\n\r') else v
    return end.join(",".join(map(out, row)) for row in rows) + end


@pytest.mark.parametrize("end,quote_all", [("\n", False), ("\n", True), ("\r\n", True)])
def test_csv_equals_the_multi_line_reader(spark, tmp_path, small_ranges, end, quote_all):
    r = random.Random(3)
    for k in range(3):
        rows = [["Job Title", "Job, Description", "n"]] + [[cell(r), cell(r), str(i)] for i in range(150)]
        rows.insert(40, ["long", '"' + "line\n" * 900, "over many ranges"])
        (tmp_path / f"{k}.csv").write_bytes(csv_text(rows, end, quote_all).encode())
    path = str(tmp_path)
    want = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    got = read_csv_ranges(spark, path)
    assert got.columns == want.columns and pieces(spark, path, "\n").rdd.getNumPartitions() > 20
    assert want.count() == 453 and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_csv_without_rows(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text("x,y\n")
    assert read_csv_ranges(spark, str(tmp_path)).collect() == [] and read_csv_ranges(spark, str(tmp_path)).columns == ["x", "y"]
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"')  # no line end at the end of the file
    assert [tuple(r) for r in read_csv_ranges(spark, str(tmp_path)).collect()] == [("1", "a\nb")]
    assert CsvCutter.measure(['a"', 'b""']) == (1, 0, 0)


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_equal_the_multi_line_reader(spark, tmp_path, small_ranges, indent):
    r = random.Random(5)
    for k in range(2):
        rows = [{"id": f"{k}-{i}", "tokens": [cell(r) for _ in range(r.randint(0, 5))], "ner_tags": [r.randint(0, 8) for _ in range(3)]} for i in range(80)]
        rows.insert(20, {"id": "long", "tokens": ["}]{[\"\\" * 400, "\\", "\\\""], "ner_tags": []})
        (tmp_path / f"{k}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=bool(k)))
    path = str(tmp_path)
    want = spark.read.schema(WORD_LEVEL_SCHEMA).option("multiLine", True).json(path)
    got = read_json_arrays(spark, path, WORD_LEVEL_SCHEMA)
    assert want.count() == 162 and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_nested_exports(spark, tmp_path, small_ranges):
    rows = [{"id": str(i), "data": {"text": cell(random.Random(i))}, "annotations": [{"id": i, "result": [
        {"value": {"start": j, "end": j + 1, "text": '"}', "labels": ["A"]}, "id": f"result-{i}-{j}", "from_name": "label", "to_name": "text", "type": "labels"}
        for j in range(i % 4)]}]} for i in range(60)]
    (tmp_path / "a.json").write_text("  " + json.dumps(rows) + "\n")
    (tmp_path / "b.json").write_text("[]")
    want = spark.read.schema(EXPORT_SCHEMA).option("multiLine", True).json(str(tmp_path))
    got = read_json_arrays(spark, str(tmp_path), EXPORT_SCHEMA)
    assert want.where("id IS NOT NULL").exceptAll(got).isEmpty() and got.count() == 60
