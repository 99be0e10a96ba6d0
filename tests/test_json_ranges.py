"""JSON read in ranges: equal to the whole text, wherever the ranges' borders lie."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.operators.dataset import raw_tiers
from tablesmith.sources import datasets, json_ranges

ODD = {
    "1950": {"tier1": [{"team": "A } , \"q\" {[", "notes": "back\\slash\\\\\" }"}], "tier2": {"table": [], "promoted": ["x}y", "\\"], "extra": {"deep": [{"a": [1, {"b": "}"}]}]}}},
    "ke\"y}": {"t,{": [{"team": "É日本}\\"}], "n": None, "s": "text", "f": 1.5, "e": {}},
    "empty": {},
    "1951": {"tier1": []},
    "null": None,
}


def texts(rng):
    big = {str(1900 + k): {f"tier{t}": [{"team": f"T{rng.random()}}}{{\"", "pos": p, "notes": rng.choice(["", "}", "\\", "a\"b", None])} for p in range(rng.randrange(5))] for t in range(1, 4)} for k in range(40)}
    for value in (ODD, big, {}, {"a": {}}):
        for spaces in (None, 2):
            for held in (value, {"seasons": value}, {"before": {"x": [1]}, "seasons": value, "after": 3}, {"seasons": None, **value}):
                yield json.dumps(held, ensure_ascii=False, indent=spaces)
    yield from ('{"seasons": 5, "1950": {"tier1": []}}', '{"seasons": [{"a": 1}]}', "[1, {}]", "", "  ", '{"1950": {"tier1": [', '{"seasons": {"1950": {"tier1": [{"team": "A"}]}}', json.dumps({"seasons": ODD}) + "\n\n", " \n" + json.dumps(ODD))


def tiers(df):
    """In order, with ranks for the numbers of the order."""
    rows = sorted(((r["season_ord"], r["tier_ord"], r["season_key"], r["tier_key"], r["tier_json"]) for r in df.collect()), key=lambda r: r[:2])
    return [r[2:] for r in rows]


@pytest.fixture
def short_ranges(spark):
    def to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ranges_equal_the_whole_text(spark, tmp_path, short_ranges):
    rng = random.Random(6)
    for k, text in enumerate(texts(rng)):
        path = str(tmp_path / f"{k}.json")
        open(path, "w", encoding="utf-8").write(text)
        want = tiers(raw_tiers(spark.createDataFrame([(0, text)], "source_rank int, value string")))
        short_ranges(max(16, len(text.encode()) // rng.choice([2, 7, 23])))
        assert tiers(json_ranges.read_ranges(spark, path)) == want, (k, text[:100])


def test_a_season_that_is_no_object_is_left_out(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": [{"b": 1}, 2], "1950": {"tier1": []}, "c": 5, "d": "{,}"}')
    assert tiers(json_ranges.read_ranges(spark, str(tmp_path / "a.json"))) == [("1950", "tier1", "[]")]


def test_long_files_are_read_in_several_tasks(spark, tmp_path, short_ranges):
    path = str(tmp_path / "a.json")
    json.dump({"seasons": {str(s): {"tier1": [{"team": f"T{p}", "pos": p} for p in range(20)]} for s in range(1900, 2000)}}, open(path, "w"))
    short_ranges(4096)
    records = spark.read.option("lineSep", "}").text(path)
    assert records.rdd.getNumPartitions() > 10
    data = datasets.load(spark, path)
    assert data.entries.count() == 2000 and data.tiers.agg(F.countDistinct("season_key")).first()[0] == 100


def test_marks_compose():
    """What two stretches say one after the other is what the whole says."""
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice(['"', "\\\\", '\\"', "{", "}", "[", "]", ",", "a"]) for _ in range(40))
        data = np.frombuffer(text.encode(), np.uint8)
        k = rng.randrange(len(data))
        while k and data[k - 1] == 0x5C:
            k -= 1
        for inside in (False, True):
            whole = json_ranges.marks(data, inside, 3)
            first = json_ranges.marks(data[:k], inside, 3)
            second = json_ranges.marks(data[k:], first.inside, first.end)
            assert whole.at.tolist() == [*first.at, *(second.at + k)] and whole.depth.tolist() == [*first.depth, *second.depth]
            assert (whole.inside, whole.end) == (second.inside, second.end)
