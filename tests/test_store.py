import json

import pytest
from pyspark.sql import functions as F

from tablesmith import cli
from tablesmith.operators.dataset import tier_json
from tablesmith.sources import datasets, pages
from tablesmith.sources.store import SeasonStore
from tests.test_pages import division, line


def data(spark, seasons):
    return datasets.from_literal(spark, json.dumps({"seasons": seasons}))


def held(dataset):
    return sorted((r["season_key"], r["tier_key"], r["json"]) for r in tier_json(dataset).collect())


def test_a_store_gives_back_what_was_put_in(spark, tmp_path):
    store = SeasonStore(spark, f"{tmp_path}/s")
    assert store.load().tiers.count() == 0 and store.batches() == [] and store.vacuum() == []
    first = {"1950": {"tier1": [{"team": "A", "notes": "promoted", "won": "x"}, {"team": "B", "pos": 2}], "tier2": []}, "a/b=c %": {"seasonInfo": {"table": [], "promoted": ["A"], "note": "é"}}}
    second = {"1950": {"tier1": [{"team": "C"}]}, "1951": {"tier1": {"table": [{"team": "D"}], "title": "T"}}}
    assert store.save(data(spark, first)) == 0
    got = store.load()
    assert held(got) == held(data(spark, first)) and got.entries.filter("team = 'A'").first()["bad_fields"] == ["won"]
    assert set(got.tiers.columns) == set(data(spark, first).tiers.columns) and set(got.entries.columns) == set(data(spark, first).entries.columns)
    assert store.save(data(spark, second)) == 1 and store.save(data(spark, {})) is None
    want = held(data(spark, {"a/b=c %": first["a/b=c %"], **second}))
    assert held(store.load()) == want and store.vacuum() == [0, 1]
    store.save(data(spark, {"a/b=c %": first["a/b=c %"]}))
    assert store.vacuum() == [1, 2] and held(SeasonStore(spark, f"file://{tmp_path}/s").load()) == want


def test_what_a_stopped_writer_leaves_does_not_count(spark, tmp_path, monkeypatch):
    store = SeasonStore(spark, f"{tmp_path}/s")
    store.save(data(spark, {"1950": {"tier1": [{"team": "A"}]}}))
    move = SeasonStore._move

    def stopped(self, source, name):
        if name.startswith("manifest"):
            raise KeyboardInterrupt
        return move(self, source, name)

    monkeypatch.setattr(SeasonStore, "_move", stopped)
    with pytest.raises(KeyboardInterrupt):
        store.save(data(spark, {"1950": {"tier1": [{"team": "B"}]}, "1951": {"tier1": []}}))
    monkeypatch.undo()
    assert [t[:2] for t in held(store.load())] == [("1950", "tier1")] and store.load().entries.first()["team"] == "A"
    assert store.save(data(spark, {"1952": {"tier1": []}})) == 2  # the number that was taken is left out
    assert {t[0] for t in held(store.load())} == {"1950", "1952"} and store.vacuum() == [0, 2]


def test_a_killed_build_leaves_its_seasons(spark, tmp_path, monkeypatch):
    page = division("First", line(1, "A"), line(2, "B", "<td>Relegated</td>"))
    asked = []

    def fetch(some, fetcher, wait_s=1.0, tasks=1):
        asked.extend(r["url"][-4:] for r in some.collect())
        if len(asked) == 3:
            raise SystemExit("killed")
        return some.selectExpr("url", f"'{page}' as html", "cast(null as string) as error")

    monkeypatch.setattr(pages, "fetch", fetch)
    monkeypatch.setattr(pages.kept_pages, "__defaults__", (1.0, 1))
    out = str(tmp_path / "out.json")
    with pytest.raises(SystemExit):
        cli.main(["build", "-s", "1901", "-e", "1904", "--wait", "0", "-o", out], spark)
    store = SeasonStore(spark, f"{out}.seasons")
    assert {r["season_key"] for r in store.load().tiers.collect()} == {"1901", "1902"} and not (tmp_path / "out.json").exists()
    assert store.load().entries.groupBy("season_key").agg(F.count("*").alias("n")).filter("n = 2").count() == 2
    asked[:] = ["", "", ""]
    assert cli.main(["build", "-s", "1901", "-e", "1904", "--wait", "0", "--update-only", "-o", out], spark) == 0
    assert len(asked) == 5 and list(json.load(open(out))["seasons"]) == ["1901", "1902", "1903", "1904"] and not (tmp_path / "out.json.seasons").exists()
