import json

import pytest

from tablesmith import cli
from tablesmith.operators import lint, merge
from tablesmith.sources import datasets, sinks


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def entry(team, **more):
    return {"pos": 1, "team": team, "played": 2, "won": 1, "drawn": 0, "lost": 1, "goalsFor": 3, "goalsAgainst": 1, "points": 2} | more


def dataset(spark, seasons):
    return datasets.from_literal(spark, json.dumps({"seasons": seasons}))


def test_entries_are_normalised(spark):
    raw = [
        {"pos": "1", "team": " Alpha FC ", "goalsFor": "82", "goalsAgainst": "44", "goalDifference": "", "notes": "Promoted to the First Division"},
        {"team": "Beta", "wasRelegated": True, "wasPromoted": "true", "won": "0x10", "played": True, "points": "1e1"},
        {"team": "Gamma", "notes": "reprived from re-election; Re-elected", "won": "two"},
        {"team": " "}, "text", None,
    ]
    data = dataset(spark, {"1950": {"tier1": raw}})
    got = {r["team"]: r for r in data.entries.collect()}
    assert sorted(got) == ["Alpha FC", "Beta", "Gamma"]
    alpha, beta, gamma = got["Alpha FC"], got["Beta"], got["Gamma"]
    assert (alpha["pos"], alpha["goal_difference"], alpha["was_promoted"], alpha["was_relegated"], alpha["played"]) == (1, 38, True, False, 0)
    assert (beta["was_relegated"], beta["was_promoted"], beta["won"], beta["played"], beta["points"]) == (True, False, 16, 1, 10)
    assert gamma["was_reprieved"] and gamma["was_re_elected"] and gamma["bad_fields"] == ["won"]


def test_tiers_lists_and_extras(spark):
    data = dataset(spark, {
        "1901": {"tier1": {"season": 1901, "table": [entry("Alpha FC", wasRelegated=True)], "promoted": [], "title": "Top"}, "tier2": [entry("Beta")]},
        "1902": {"seasonInfo": {"season": "1902", "promoted": [" B ", "B", ""], "table": []}, "note": "x"},
    })
    tiers = {(r["season_key"], r["tier_key"]): r for r in data.tiers.collect()}
    assert set(tiers) == {("1901", "tier1"), ("1901", "tier2"), ("1902", "seasonInfo")}
    first = tiers["1901", "tier1"]
    assert first["relegated"] == ["Alpha FC"] and first["promoted"] == [] and first["extra"] == {"title": "Top"} and first["tier_season"] == 1901
    assert tiers["1901", "tier2"]["tier_kind"] == "array" and tiers["1901", "tier2"]["promoted"] is None
    assert tiers["1902", "seasonInfo"]["promoted"] == ["B"]


def test_json_round_trip(spark, tmp_path):
    seasons = {
        "abc": {"tier1": []}, "1955": {"seasonInfo": {"season": 1955, "table": [], "promoted": ["É \"q\""], "relegated": [], "seasonSlug": "1955–56"}, "tier1": {"title": "Top", "season": 1955, "table": [entry("A", goalAverage=1.5, notes=None)]}},
    }
    path = str(tmp_path / "out" / "a.json")
    sinks.save_json(dataset(spark, seasons), path)
    saved = json.load(open(path))
    assert list(saved["seasons"]) == ["1955", "abc"] and list(saved["seasons"]["1955"]["tier1"]) == ["title", "season", "table", "relegated", "promoted"]
    row = saved["seasons"]["1955"]["tier1"]["table"][0]
    assert list(row)[:5] == ["pos", "team", "played", "won", "drawn"] and row["goalDifference"] == 2 and row["goalAverage"] == 1.5 and row["wasPromoted"] is False
    assert saved["seasons"]["1955"]["seasonInfo"]["promoted"] == ['É "q"'] and saved["seasons"]["1955"]["seasonInfo"]["seasonSlug"] == "1955–56"
    sinks.save_json(datasets.load(spark, path), str(tmp_path / "b.json"), False)
    assert json.load(open(tmp_path / "b.json")) == saved and "\n" not in open(tmp_path / "b.json").read()
    assert json.load(open(sinks.minify(spark, path))) == saved and datasets.load(spark, str(tmp_path / "none.json")).tiers.count() == 0


def test_combine(spark, tmp_path):
    a = {"2000": {"tier1": [entry("Rich", goalDifference=999)]}, "1915": {"tier1": [entry("War")]}, "abc": {"tier1": []}}
    b = {"2000": {"tier1": [], "tier2": [entry("Two")], "seasonInfo": {"table": [], "season": 2000}}, "2001": {"tier1": []}}
    paths = []
    for name, seasons in (("a", a), ("b", b)):
        paths.append(str(tmp_path / f"{name}.json"))
        json.dump({"seasons": seasons}, open(paths[-1], "w"))
    data, figures = merge.combine([datasets.load(spark, p, "error") for p in paths])
    assert rows(data.entries, "season_key", "tier_key", "team", "goal_difference") == [("2000", "tier1", "Rich", 2), ("2000", "tier2", "Two", 2)]
    assert figures.first().asDict() == {"merged_seasons": 1, "inputs": 2, "excluded": 2, "removed_war_seasons": 1, "missing_seasons": [2001], "missing_keys": ["abc"], "input_seasons": 5}
    with_empty, _ = merge.combine([datasets.load(spark, p) for p in paths], include_empty=True)
    assert rows(with_empty.entries, "season_key", "tier_key", "team") == [("2000", "tier2", "Two")]
    with pytest.raises(FileNotFoundError, match="Input file not found"):
        datasets.load(spark, str(tmp_path / "none.json"), "error")
    assert cli.main(["combine", *paths, "-o", str(tmp_path / "all.json")], spark) == 0
    assert list(json.load(open(tmp_path / "all.json"))["seasons"]) == ["2000"]


def test_lint_finds_each_fault_and_nothing_else(spark):
    good = [entry("A", pos=1, wasPromoted=True), entry("B", pos=2)]
    bad = [entry("A", pos=1), entry(" a", pos=1, played=9), entry("C", pos=3, wasPromoted=True, wasRelegated=True)]
    data = dataset(spark, {
        "1950": {"tier1": {"season": 1950, "table": good, "promoted": ["a "], "relegated": []}},
        "1951": {"tier1": {"season": 1952, "table": bad, "promoted": ["Z"], "relegated": ["Y"]}, "tier2": []},
        "1953": {"tier1": []},
    })
    issues = lint.lint(data)
    of_tier1 = ("season-mismatch", "duplicate-teams", "duplicate-positions", "match-count-mismatch", "promoted-mismatch", "promoted-unknown", "relegated-mismatch", "relegated-unknown")
    want = {("1951", "tier1", rule) for rule in of_tier1} | {("1951", "tier2", "empty-tier"), ("1953", None, "missing-season-data")}
    assert {(r["season_key"], r["tier_key"], r["rule"]) for r in issues.collect()} == want
    assert not [r for r in issues.collect() if r["season_key"] == "1950"]
    messages = {r["rule"]: r["message"] for r in issues.collect()}
    assert messages["duplicate-teams"] == "Duplicate teams detected: A" and messages["duplicate-positions"].endswith(": 1") and messages["match-count-mismatch"].endswith(": a")
    assert messages["promoted-mismatch"].endswith(": C") and messages["promoted-unknown"].endswith(": Z") and len(sinks.issue_lines(issues)) == 10
    assert lint.lint(dataset(spark, {"1950": {"tier1": [entry("A", goalDifference=7)]}}), raw_differences=True).first()["rule"] == "goal-diff-mismatch"


def test_overview_lint(spark, capsys):
    seasons = {
        "2008": {"seasonInfo": {"tableCount": 1}, "tier1": {"title": "T", "table": [entry("A"), entry("a", pos=1), entry("", pos=1.5), {"team": "D"}], "seasonMetadata": {"tableIndex": 2, "tableCount": 5}}, "tier3": {"table": []}},
        "2009": {"tier1": {"title": "X"}}, "2010": {"seasonInfo": {"tableCount": 1}, "tier1": {"title": "T", "table": [entry("A")], "seasonMetadata": {"tableIndex": 0, "tableCount": 1}}},
    }
    found = rows(lint.lint_overview(datasets.raw_literal(spark, json.dumps({"seasons": seasons}))), "season_key", "severity", "message")
    text = " | ".join(m for _, _, m in found)
    for part in ("tableCount=1, actual=2", "non-sequential: found [tier1, tier3]", "tier 1 (T): seasonMetadata.tableIndex=2 but expected 0", "tableCount=5 but season has 2", "tier 3 ((untitled league)): table is empty",
                 "row 3: missing team name", "row 4: missing or invalid pos", "row 3: pos is not an integer (1.5)", "duplicate position 1 (rows 1 and 2)", 'duplicate team name "a" (rows 1 and 2)', "Missing seasonInfo block", "tier 1 (X): table is missing or not an array"):
        assert part in text
    assert not [s for s, _, _ in found if s == "2010"] and len(found) == 12
    assert cli.main(["lint-overview", "--json", "{}"], spark) == 1 and "Missing top-level" in capsys.readouterr().out
