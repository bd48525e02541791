"""The splittable document scan against Spark's own reader and Python's JSON."""

from __future__ import annotations

import json
import random

import pytest

SCHEMA = "a string, b array<string>, c struct<d:int>"


def _document(rng):
    def text():
        return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", "é", " ", "\n", "x", ":", ","]) for _ in range(rng.randrange(12)))
    rows = [{"a": text(), "b": [text() for _ in range(rng.randrange(3))], "c": {"d": i}} for i in range(rng.randrange(1, 12))]
    other = [{"a": "other", "b": [], "c": {"d": -1}}]
    parts = {text() + "x": [other, rng.choice([1, "{", None])][1], "Before": other, "Foods": rows, "After [": other}
    return rows, json.dumps(parts, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)


@pytest.mark.parametrize("chunk", [1, 3, 7, 64, 1 << 20])
def test_records_at_every_cut(spark, tmp_path, chunk):
    from pyspark.sql import types as T
    from labelcorpus.sources.survey_scan import read_split
    rng = random.Random(chunk)
    for i in range(2):
        rows, text = _document(rng)
        if chunk < 64:  # a task per piece: keep the number of pieces small
            rows, text = rows[:2], json.dumps({"Foods": rows[:2], "Z": []})[:]
            if len(text) > 60 * chunk:
                rows, text = [{"a": '\\"', "b": [], "c": {"d": 1}}], '{"Foods":[{"a":"\\\\\\"","b":[],"c":{"d":1}}]}'
        path = tmp_path / f"d{i}.json"
        path.write_text(text, encoding="utf-8")
        got = read_split(spark, str(path), "Foods", T.StructType.fromDDL(SCHEMA), chunk).collect()
        want = [(r["a"], r["b"], r["c"]["d"]) for r in rows]
        assert sorted((r["a"], list(r["b"]), r["c"]["d"]) for r in got) == sorted(want)


def test_cuts_without_spark(tmp_path):
    """The fold and the cuts at every piece size, in plain Python."""
    import pyarrow as pa
    from labelcorpus.sources import survey_scan as S
    rng = random.Random(3)
    for n in range(25):
        rows, text = _document(rng)
        data = text.encode()
        path = tmp_path / f"p{n}.json"
        path.write_bytes(data)
        uri = path.as_uri()
        for chunk in (1, 2, 5, 13, 50, 1000):
            pieces = [{"number": i, "start": i * chunk, "stop": min(len(data), (i + 1) * chunk)} for i in range(-(-len(data) // chunk))]
            sums = [b.to_pylist()[0] for b in S._summarise(iter([pa.RecordBatch.from_pylist(pieces)]), uri)]
            in_string = depth = 0
            for piece, s in zip(pieces, sums):
                piece.update(in_string=in_string, depth=depth)
                depth += s["opened_inside"] if in_string else s["opened_outside"]
                in_string ^= s["flips"]
            assert (in_string, depth) == (0, 0)
            found = [r for b in S._cut(iter([pa.RecordBatch.from_pylist(pieces)]), uri, chunk) for r in b.to_pylist()]
            assert [r["key"] for r in found if r["key"] is not None] == ["Before", "Foods", "After ["]
            records = [json.loads(r["record"]) for r in found if r["record"] is not None]
            assert [r for r in records if r["a"] != "other"] == rows


def test_survey_document_equals_the_plain_reader(spark, survey_path, tmp_path):
    from labelcorpus.sources import survey as S
    key = ["fdcId", "foodCode", "description", "foodNutrients", "inputFoods", "foodPortions"]
    assert sorted(map(str, S.read_survey(spark, survey_path, "split").select(*key).collect())) == \
        sorted(map(str, S.read_survey(spark, survey_path).select(*key).collect()))
    (tmp_path / "cut.json").write_text('{"SurveyFoods": [{"fdcId": 1}, {"fdcId": ')
    with pytest.raises(ValueError, match="no whole JSON document"):
        S.read_survey(spark, str(tmp_path / "cut.json"), "split")
    (tmp_path / "empty.json").write_text("")
    assert S.read_survey(spark, str(tmp_path / "empty.json"), "split").count() == 0


def test_a_document_is_written_by_many_tasks_in_order(spark, tmp_path):
    """Sorted by many tasks, joined by one that only copies; the lines are those of the order, whatever they hold."""
    from labelcorpus.sources import survey_scan
    lines = spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 5000 AS i", "concat('row ', (id * 7919) % 5000, ' é\"{') AS value")
    path = str(tmp_path / "document.json")
    size = survey_scan.write_document(lines, ["i"], path)
    data = open(path, "rb").read()
    assert len(data) == size and data.decode().splitlines() == [f'row {i} é"{{' for i in range(5000)]
