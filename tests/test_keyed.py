"""Keyed JSON objects that span many splits."""

import json
import random

import pytest
from pyspark.sql import functions as F

from grovekit.plans import preparation as P
from grovekit.sources import keyed as SK, writers as SW


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    kept = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def samples(n, seed):
    rng = random.Random(seed)
    parts = ["}", "{", '"', "\\", "\\\\", '\\"', "{}", '"}, "', "é", "\n", " ", "x", "日本", "\t", "},", ': {"a": 1}', "\x00"]
    return {f"java_{i}": {"code": "".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 30, 400]))),
                          "avg_line_length": i / 4, "line_count": i} for i in range(n)}


@pytest.mark.parametrize("style", [{}, {"indent": 4}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_object_in_many_splits(spark, tmp_path, small_splits, style):
    files = {"one.json": samples(120, 1), "two.json": samples(1, 2), "none.json": {}, "three.json": samples(40, 3)}
    for name, data in files.items():
        (tmp_path / name).write_text(json.dumps(data, **style))
    (tmp_path / "empty.json").write_text("")
    pieces = SK._pieces(spark, str(tmp_path))
    assert pieces.select("path", "split").distinct().count() > 20
    got = sorted(map(tuple, SK.scan_keyed_object(spark, str(tmp_path)).collect()))
    assert got == sorted(("java", k, *v.values()) for data in files.values() for k, v in data.items())


def test_lines_and_nested_values(spark, tmp_path, small_splits):
    rows = samples(50, 4)
    lines = "\n".join(json.dumps({k: v}) for k, v in rows.items())
    (tmp_path / "lines.json").write_text(lines)
    assert {r.key for r in SK.scan_keyed_object(spark, str(tmp_path)).collect()} == set(rows)
    nested = {f"k_{i}": {"a": {"b": [{"c": "}"}] * i}, "code": "{"} for i in range(30)}
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "nested.json").write_text(json.dumps(nested))
    found = {}
    for r in SK.keyed_entries(spark, str(tmp_path / "deep")).collect():
        found |= json.loads(r.value)
    assert found == nested


def test_file_cut_off(spark, tmp_path):
    whole = json.dumps(samples(20, 5))
    (tmp_path / "cut.json").write_text(whole[: whole.index('"java_19"') + 12])
    assert {r.key for r in SK.scan_keyed_object(spark, str(tmp_path)).collect()} == {f"java_{i}" for i in range(19)}


def test_written_object_is_valid(spark, tmp_path):
    rows = [(i, "c" if i % 3 else "go", f"a{{ '\"\\\n line {i}") for i in range(90)]
    df = P.with_raw_metrics(spark.createDataFrame(rows, "id long, language string, code string"))
    SW.write_keyed_object(df, str(tmp_path / "out"), "id")
    for language, n in (("go", 30), ("c", 60)):
        files = list((tmp_path / "out" / f"language={language}").glob("part*"))
        assert len(files) == 1
        data = json.loads(files[0].read_text())
        assert list(data) == [f"{language}_{i}" for i in range(n)]
    back = SK.scan_keyed_object(spark, str(tmp_path / "out"))
    assert sorted(r.code for r in back.collect()) == sorted(c for _, _, c in rows)
    assert back.agg(F.countDistinct("key")).first()[0] == 90
