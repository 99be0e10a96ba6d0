import csv

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablesmith import cli
from tablesmith.operators import standings
from tablesmith.sources import matches, sinks

SCHEMA = "season int, tier int, match_ord long, home string, visitor string, hgoal int, vgoal int, result string"
TEAMS = ("A", "B", "C", "D")


def brute(rows):
    tables, seen = {}, {}
    for season, tier, order, home, visitor, hg, vg, result in sorted(rows, key=lambda r: r[2]):
        for side, team, gf, ga, win in ((0, home, hg, vg, "H"), (1, visitor, vg, hg, "A")):
            t = tables.setdefault((season, tier), {}).setdefault(team, [0] * 6)
            seen.setdefault((season, tier, team), 2 * order + side)
            won, drawn = result == win, result == "D"
            for k, v in enumerate((1, won, drawn, result in "HA" and not won, gf or 0, ga or 0)):
                t[k] += v
    out = {}
    for (season, tier), teams in tables.items():
        def rank(item):
            team, (p, w, d, l, gf, ga) = item
            tie = (gf / ga if ga else gf) if season <= 1975 else gf - ga
            return -(w * (2 if season <= 1980 else 3) + d), -tie, -gf, seen[season, tier, team]

        for pos, (team, values) in enumerate(sorted(teams.items(), key=rank), 1):
            out[season, tier, team] = (pos, *map(int, values))
    return out


match = st.tuples(st.sampled_from([1897, 1975, 1980, 1981, 1995]), st.sampled_from([1, 2]), st.sampled_from(TEAMS), st.sampled_from(TEAMS), st.integers(0, 4) | st.none(), st.integers(0, 4), st.sampled_from("HAD?"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(match, max_size=40))
def test_tables_match_plain_counting(spark, rows):
    rows = [(s, t, k, h, v, a, b, r) for k, (s, t, h, v, a, b, r) in enumerate(rows) if h != v]
    table = standings.league_table(spark.createDataFrame(rows, SCHEMA)).collect()
    got = {(r["season"], r["tier"], r["team"]): (r["pos"], r["played"], r["won"], r["draw"], r["lost"], r["goals_for"], r["goals_against"]) for r in table}
    assert got == brute(rows)
    for key in {k[:2] for k in got}:
        own = [v for k, v in got.items() if k[:2] == key]
        assert sorted(v[0] for v in own) == list(range(1, len(own) + 1)) and sum(v[5] for v in own) == sum(v[6] for v in own)


def test_movements_follow_the_season_rules(spark):
    rows = []
    for season, n in ((1890, 4), (1950, 4), (1985, 7), (1995, 9), (2000, 2)):
        for tier in (1, 2):
            rows += [(season, tier, k * 100 + j, f"{tier}-{k}", f"{tier}-{j}", 9 - k, 0, "H") for k in range(n) for j in range(n) if k < j]
    got = {r["team"]: (r["promoted"], r["relegated"]) for r in standings.movements(standings.league_table(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got["2-0"] == (3, 0) and got["2-1"] == (3, 0) and got["2-2"] == (1, 0)
    assert got["1-3"] == (0, 1) and got["1-6"] == (0, 2) and got["1-8"] == (0, 1) and "1-0" not in got and "2-3" not in got


def test_csv_in_and_out(spark, tmp_path):
    source = tmp_path / "england.csv"
    with open(source, "w", newline="") as file:
        out = csv.writer(file)
        out.writerow(["Season", "home", "visitor", "hgoal", "vgoal", "result", "tier"])
        for season in range(1888, 1945):
            out.writerow([season, " Alpha ", "Beta", 2, "", "H", 1])
            out.writerow([f"{season}-x", "Gamma", "Beta", 1, 1, "D", 2])
    rows = matches.read_csv(spark, str(source))
    assert {r["chunk"] for r in sinks.with_chunks(rows.drop("file", "row_ord")).select("chunk").distinct().collect()} == {"1888-1912", "1913-1937", "1938-1944"}
    table = standings.league_table(matches.as_matches(rows))
    assert {(r["team"], r["points"], r["goals_for"]) for r in table.filter("season = 1888 and tier = 1").collect()} == {(" Alpha ", 2, 2), ("Beta", 0, 0)}
    assert [(r["id"], r["name"]) for r in standings.club_ids(matches.as_matches(rows)).orderBy("id").collect()] == [("club_1", "Alpha"), ("club_2", "Beta"), ("club_3", "Gamma")]
    assert cli.main(["split", str(source), "-o", str(tmp_path / "tiers")], spark) == 0 and cli.main(["split", str(source), "-o", str(tmp_path / "chunks"), "--chunks"], spark) == 0
    assert spark.read.csv(str(tmp_path / "tiers"), header=True).filter("tier = 1").count() == 57
    assert {p.name for p in (tmp_path / "chunks" / "tier=1").iterdir()} == {"chunk=1888-1912", "chunk=1913-1937", "chunk=1938-1944"}
    assert cli.main(["tables", str(source), "-o", str(tmp_path / "out")], spark) == 0 and spark.read.parquet(str(tmp_path / "out" / "tables")).count() == table.count()
