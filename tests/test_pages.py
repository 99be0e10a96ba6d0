import json

import pytest

from tablesmith import cli
from tablesmith.functions import dom
from tablesmith.operators import html, seasons, textpages
from tablesmith.sources import pages

HEAD = "<tr><th>Pos</th><th>Club</th><th>Pld</th><th>Won</th><th>Drawn</th><th>Lost</th><th>GF</th><th>GA</th><th>Pts</th>{}</tr>"


def line(pos, team, notes="", points=20, head=""):
    return f"<tr><td>{pos}</td><td>{team}</td><td>30</td><td>8</td><td>4</td><td>18</td><td>40</td><td>60{head}</td><td>{points}</td>{notes}"


def division(name, *lines, extra="<th>Notes</th>", after=""):
    return f'<div><span id="{name}_Division" class="mw-headline">{name} Division</span></div><table class="wikitable">{HEAD.format(extra)}{"".join(lines)}</table>{after}'


def test_tree_closes_what_is_implied():
    root = dom.parse("<table><tr><td>a<td>b<tr><td>c<table><tr><td>d</table>e</table><p>x<p>y &amp; z<br>w<!-- no -->")
    outer = root.tags("table")[0]
    assert [len([c for c in t.children if isinstance(c, dom.Node)]) for t in outer.children] == [2, 1]
    assert [n.text() for n in root.tags("p")] == ["x", "y & zw"] and outer.text() == "abcde"


def test_division_table():
    page = division("First", line(1, "Alpha<sup class='reference'>[1]</sup>", "<td>Relegated to the Second Division</td>"), line(2, "Beta [2]", "<td rowspan=2>New club; promoted</td>"), line(3, "Gamma"), line("", "No place"), "<tr><td>Team</td><td>Pld</td></tr>")
    rows = html.parse_division(page, "first")
    assert [(r["pos"], r["team"], r["was_relegated"], r["is_expansion_team"], r["was_promoted"], r["row_ord"]) for r in rows] == [(1, "Alpha", True, False, False, 0), (2, "Beta", False, True, False, 1), (3, "Gamma", False, True, False, 2)]
    assert html.parse_division("<p>nothing</p>", "first") == [] == html.parse_division(None, "second")
    legacy = '<div><span id="Final_league_table">x</span></div><table class="wikitable"><tr><th>No</th><th>Side</th><th>P</th><th>Pts</th><th>Remarks</th></tr><tr><td>1</td><th scope="row"><a>Side A</a> x</th><td>10</td><td>−9</td><td rowspan="2">Promoted</td></tr><tr><td>2</td><td>Side B</td><td>10</td><td>8</td></tr></table>'
    rows = html.parse_division(legacy, "second")
    assert [(r["team"], r["points"], r["was_promoted"]) for r in rows] == [("Side A", 9, True), ("Side B", 8, True)]
    legend = division("Second", line(1, "Up <b>(C, P)</b>"), line(2, "Down <i>R</i>"), extra="", after='<div class="Legend">(P, O) Promoted to first; (R) Relegated</div>')
    assert [(r["team"], r["was_promoted"], r["was_relegated"], r["notes"]) for r in html.parse_division(legend, "second")] == [("Up (C, P)", True, False, "20"), ("Down R", False, True, "20")]


def wrapped(level, title, head_id):
    return f'<div class="mw-heading mw-heading{level}"><h{level} id="{head_id}">{title}</h{level}></div>'


def overview(*rows, after=""):
    return f'<table class="wikitable">{HEAD.format("")}{"".join(rows)}</table>{after}'


def test_overview_tables():
    page = wrapped(2, "League tables", "League_tables") + wrapped(3, "Premier League", "PL") + overview(line(1, "Alpha"), line(2, "Beta <span>(R)</span>", points="−5"), after='<div class="sports-table-notes">(R) Relegated; (P) Promoted</div>')
    page += wrapped(3, "First Division", "FD") + wrapped(4, "Play-offs", "PO") + overview(line(1, "Skipped")) + wrapped(3, "Second Division", "SD") + overview(line(1, "Gamma <span>(P)</span>"), after='<div class="legend">(P) Promoted</div>') + wrapped(2, "Cups", "Cups") + wrapped(3, "Cup", "Cup") + overview(line(1, "Cup winner"))
    tables = html.parse_overview(page)
    assert [(t["title"], t["is_top_flight"], [r["team"] for r in t["rows"]]) for t in tables] == [("Premier League", True, ["Alpha", "Beta (R)"]), ("Play-offs", False, ["Skipped"]), ("Second Division", False, ["Gamma (P)"])]
    assert tables[0]["rows"][1]["was_relegated"] and tables[0]["rows"][1]["points"] == -5 and tables[2]["rows"][0]["was_promoted"]
    generic = wrapped(2, "The Football League", "TFL") + wrapped(3, "League table", "LT") + overview(line(1, "Alpha"))
    assert [(t["title"], t["heading_id"]) for t in html.parse_overview(generic)] == [("The Football League", "LT")]
    assert html.parse_overview("<h2>History</h2>") == []


def test_infobox():
    box = '<table class="infobox"><caption class="infobox-title"><a>The Football League</a></caption><tr><th>Season</th><td>1901–02</td></tr><tr><th>Relegated</th><td>None</td></tr><tr><th>New Clubs in League</th><td><a>A</a>, <a>B</a></td></tr></table>'
    assert html.parse_infobox(box) == {"season": "1901–02", "relegated": [], "new_clubs": ["A", "B"], "folded": [], "resigned": []}
    assert html.parse_infobox("<p>") == {"season": "", "relegated": [], "new_clubs": [], "folded": [], "resigned": []}


TEXT = """
Football League First Division - 1908/09

                       P  W  D  L  F  A   W  D  L  F  A   +/-  Pts
 1. NEWCASTLE UNITED  38 14  1  4 41 20  10  4  5 24 21   24   53 +
 2. Everton           38 11  3  5 51 28   7  7  5 31 29   25   46
 3. LEICESTER FOSSE   38  6  6  7 32 41   2  3 14 22 61  -48   25 *
+ Champions
* Relegated, re-elected later
 4. Late Row          38  6  6  7 32 41   2  3 14 22 61   25
 5. Bad Row           38 +6  6  7 32 41   2  3 14 22 61   25
 6. Never Seen        38  6  6  7 32 41   2  3 14 22 61   25
"""


def test_text_pages(spark):
    page = f"<pre>{TEXT}</pre><pre>no table</pre><pre>{TEXT.replace('First', 'Second')}</pre>"
    frame = spark.createDataFrame([("p", page)], "page_id string, html string")
    heads, rows = textpages.competitions(html.text_blocks(frame, ["page_id"]))
    got = {r["block_no"]: r for r in heads.collect()}
    assert set(got) == {0, 2} and got[0]["first_division"] and not got[2]["first_division"]
    assert (got[0]["league"], got[0]["season"], got[0]["season_slug"]) == ("Football League First Division", "1908/09", "1908-09")
    table = [r for r in sorted(rows.collect(), key=lambda r: (r["block_no"], r["row_ord"]))]
    first = [r for r in table if r["block_no"] == 0]
    assert [(r["pos"], r["team"], r["won"], r["goals_for"], r["goal_difference"], r["points"], r["notes"]) for r in first] == [
        (1, "Newcastle united", 24, 65, 24, 53, "Champions"), (2, "Everton", 18, 82, 25, 46, None), (3, "Leicester fosse", 8, 54, -48, 25, "Relegated, re-elected later"), (4, "Late row", 8, 54, -48, 25, None),
    ]
    assert [(r["was_promoted"], r["was_relegated"], r["was_re_elected"]) for r in first[:3]] == [(False, False, False), (False, False, False), (False, False, True)]
    assert [r["was_promoted"] for r in table if r["block_no"] == 2][0] and first[0]["meta"]["highlighted"]
    labels = textpages.page_seasons(heads).first()
    assert labels["seasons"] == ["1908/09"] and labels["season_slug"] == "1908-09"
    data = seasons.text_seasons(heads, rows, spark.createDataFrame([("p", 1908, "1908-09")], "page_id string, season int, season_slug string"))
    assert {(r["tier_key"], r["tier_kind"], r["n_rows"]) for r in data.tiers.collect()} == {("tier1", "object", 4), ("tier2", "array", 4)}


def test_encodings_and_urls(spark, tmp_path):
    assert pages.decode(b"caf\xe9 \x93x\x94 \x81") == "café “x” \x81" and pages.decode("é".encode(), "utf-8") == "é" and pages.decode("é".encode(), "no-such") == "é"
    assert pages.charset("text/html; charset=ISO-8859-1; x") == "iso-8859-1" and pages.charset(None) is None
    (tmp_path / "a.html").write_bytes(b"<pre>\xe9</pre>")
    assert [r["html"] for r in pages.local_pages(spark, str(tmp_path / "a.html")).collect()] == ["<pre>é</pre>"]
    urls = {r["season"]: r["url"] for r in pages.season_urls(pages.season_years(spark, 1898, 1899), "x/{seasonSlug}/{seasonCompact}/{other}").collect()}
    assert urls == {1898: "x/1898-99/189899/{other}", 1899: "x/1899-00/189900/{other}"}
    assert [r["slug"] for r in pages.promotion_pages(pages.season_years(spark, 1899, 1899)).collect()] == ["1899-1900_Football_League"]
    with pytest.raises(ValueError):
        pages.season_years(spark, 2, 1)


def fail(url):
    raise OSError("down")


def test_fetch_failures_are_rows(spark):
    frame = spark.createDataFrame([(1, "u")], "season int, url string")
    assert [(r["html"], r["error"]) for r in pages.fetch(frame, fail, 0).collect()] == [(None, "down")]
    got = pages.fetch(frame, pages.first_of(fail, lambda url: (b"<p>ok", "")), 0).first()
    assert (got["html"], got["error"]) == ("<p>ok", None)


def test_build_and_update_from_a_table_of_pages(spark, tmp_path):
    page = division("First", line(1, "A"), line(2, "B", "<td>Relegated</td>")) + division("Second", line(1, "Club C", "<td>Promoted</td>"))
    made = [("https://en.wikipedia.org/wiki/1901-02_Football_League", page), ("https://en.wikipedia.org/wiki/1902-03_Football_League", "<p>")]
    table, out = str(tmp_path / "pages"), str(tmp_path / "out.json")
    spark.createDataFrame(made, "url string, html string").write.parquet(table)
    assert cli.main(["build", "-s", "1901", "-e", "1902", "--pages", table, "-o", out], spark) == 0
    saved = json.load(open(out))["seasons"]
    assert saved["1901"]["seasonInfo"]["promoted"] == ["Club C"] and saved["1901"]["seasonInfo"]["relegated"] == ["B"] and saved["1901"]["tier1"]["promoted"] == []
    assert set(saved["1901"]) == {"seasonInfo", "tier1", "tier2"} and set(saved["1902"]) == {"seasonInfo", "tier1"} and saved["1901"]["tier1"]["seasonSlug"] == "1901-02_Football_League"
    assert [r["season"] for r in seasons.seasons_to_fetch(pages.season_years(spark, 1901, 1902), cli.datasets.load(spark, out), update_only=True).collect()] == [1902]
    assert [r["season"] for r in seasons.seasons_to_fetch(pages.season_years(spark, 1914, 1920), None, skip_war=True).orderBy("season").collect()] == [1914, 1920]


def test_overview_seasons(spark, tmp_path):
    page = wrapped(2, "League tables", "League_tables") + wrapped(3, "Premier League", "PL") + overview(line(1, "A"), line(2, "B (R)"), after='<div class="legend">(R) Relegated</div>') + wrapped(3, "Championship", "CH") + overview(line(1, "C (P)"), after='<div class="legend">(P) Promoted</div>')
    table, out = str(tmp_path / "pages"), str(tmp_path / "o.json")
    spark.createDataFrame([("https://en.wikipedia.org/wiki/2008–09_in_English_football", page)], "url string, html string").write.parquet(table)
    assert cli.main(["overview", "--pages", table, "-o", out], spark) == 0
    season = json.load(open(out))["seasons"]["2008"]
    assert season["seasonInfo"]["promoted"] == ["C (P)"] and season["seasonInfo"]["relegated"] == ["B (R)"] and season["seasonInfo"]["tableCount"] == 2
    assert season["tier2"]["title"] == "Championship" and season["tier2"]["seasonMetadata"] == {"leagueId": "CH", "tableIndex": 0, "tableCount": 2, "seasonSlug": "2008–09_in_English_football"}
