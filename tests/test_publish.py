import json

import pytest
from pyspark.sql import functions as F

from tablesmith import cli
from tablesmith.sources import datasets, publish, sinks
from tests.test_json_ranges import ODD, short_ranges  # noqa: F401


def seasons(n):
    return {str(s): {"tier1": [{"team": f"É{s} \"q\" {{,}}", "pos": p, "notes": "a\nb\\"} for p in range(3)]} for s in range(1900, 1900 + n)} | {"b": {"tier1": []}, "a": {}}


def expected(saved, spaces):
    return json.dumps(saved, ensure_ascii=False, indent=spaces, separators=None if spaces else (",", ":"))


@pytest.mark.parametrize("pretty", [True, 4, False])
def test_many_tasks_write_one_file_in_order(spark, tmp_path, pretty):
    data = datasets.from_literal(spark, json.dumps({"seasons": seasons(60)}))
    path = f"{tmp_path}/out dir/a é.json"
    for again in range(2):
        sinks.save_json(data, path, pretty)
        text = open(path, encoding="utf-8").read()
        saved = json.loads(text)
        assert list(saved["seasons"]) == [*map(str, range(1900, 1960)), "b"] and text == expected(saved, 2 if pretty is True else pretty or None)
    assert [p.name for p in (tmp_path / "out dir").iterdir()] == ["a é.json"]


def test_a_failure_leaves_the_old_file(spark, tmp_path):
    path = f"file://{tmp_path}/a.txt"
    publish.publish(spark.range(5).select(F.col("id").cast("string").alias("value")).orderBy("value"), path, ";", "<", ">")
    assert (tmp_path / "a.txt").read_text() == "<0;1;2;3;4;>"
    with pytest.raises(Exception, match="late"):
        publish.publish(spark.range(5).select(F.raise_error(F.lit("late")).cast("string").alias("value")), path, ";")
    assert (tmp_path / "a.txt").read_text() == "<0;1;2;3;4;>" and [p.name for p in tmp_path.iterdir()] == ["a.txt"]
    publish.publish(spark.range(0).select(F.col("id").cast("string").alias("value")), path, ";", "<", ">")
    assert (tmp_path / "a.txt").read_text() == "<>"


def test_file_systems_without_places(spark, tmp_path, monkeypatch):
    """What a store gets that can neither be written at places nor join files."""
    monkeypatch.setattr(publish, "_place", publish._join)
    path = f"{tmp_path}/a.txt"
    publish.publish(spark.range(30).select(F.format_string("%02d", "id").alias("value")).orderBy("value"), path, ";", "<é", ">")
    assert (tmp_path / "a.txt").read_text(encoding="utf-8") == "<é" + "".join(f"{k:02};" for k in range(30)) + ">"


def test_minify_leaves_out_space_alone(spark, tmp_path, short_ranges, capsys):  # noqa: F811
    big = {"seasons": seasons(20) | ODD, "n": [1.0, 1e3, -0.5, True, None], "s": " } \\ \"   "}
    for k, tail in enumerate(("", "\n", " \n\t ")):
        path = f"{tmp_path}/a{k}.json"
        open(path, "w", encoding="utf-8").write(json.dumps(big, indent=3, ensure_ascii=False) + tail)
        short_ranges(700)
        assert cli.main(["minify", path, "-s", ".small"], spark) == 0
        small = open(f"{tmp_path}/a{k}.small.json", encoding="utf-8").read()
        assert small == json.dumps(big, separators=(",", ":"), ensure_ascii=False)
        assert sinks.minify(spark, f"file://{path}", in_place=True) == f"file://{path}" and open(path, encoding="utf-8").read() == small
    for text in ("{\"a\": 1", "[1, 2]", "{} x"):
        (tmp_path / "bad.json").write_text(text)
        with pytest.raises(ValueError, match="no whole JSON object"):
            sinks.minify(spark, f"{tmp_path}/bad.json", in_place=True)
        assert (tmp_path / "bad.json").read_text() == text
