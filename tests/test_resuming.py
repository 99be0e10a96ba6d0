import json

from tablesmith import cli
from tablesmith.functions.league import labels_year
from tablesmith.operators import lint
from tablesmith.sources import datasets, pages, sinks
from tests.test_pages import division, line


class Served:
    """A fetcher of two pages that fails for a third until it is mended; told by a file, as it runs in a task."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, url):
        with open(f"{self.folder}/asked", "a") as out:
            out.write(url + "\n")
        if url.endswith("c") and not (open(f"{self.folder}/mended").read() if url else ""):
            raise OSError("down")
        return f"<p>{url}".encode(), "text/html; charset=utf-8"


def test_pages_are_kept_and_not_fetched_again(spark, tmp_path):
    (tmp_path / "mended").write_text("")
    served, folder = Served(tmp_path), str(tmp_path / "kept")
    wanted = spark.createDataFrame([(k, f"u/{u}") for k, u in enumerate("abc")], "season int, url string")
    got, whole = pages.kept_pages(wanted, served, folder, 0, 2)
    rows = {r["url"]: (r["season"], r["html"], r["error"]) for r in got.collect()}
    assert whole and rows == {"u/a": (0, "<p>u/a", None), "u/b": (1, "<p>u/b", None), "u/c": (2, None, "down")}
    (tmp_path / "mended").write_text("yes")
    got, _ = pages.kept_pages(wanted, served, folder, 0, 2)
    assert {r["url"]: r["error"] for r in got.collect()} == {"u/a": None, "u/b": None, "u/c": None}
    assert (tmp_path / "asked").read_text().split() == ["u/a", "u/b", "u/c", "u/c"]


def test_an_interrupt_saves_what_has_come(spark, tmp_path, monkeypatch):
    page = division("First", line(1, "A"), line(2, "B", "<td>Relegated</td>"))
    calls = []

    def fetch(some, fetcher, wait_s=1.0, tasks=1):
        calls.append(1)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return some.selectExpr("url", f"'{page}' as html", "cast(null as string) as error")

    monkeypatch.setattr(pages, "fetch", fetch)
    monkeypatch.setattr(pages.kept_pages, "__defaults__", (1.0, 1))
    out = str(tmp_path / "out.json")
    assert cli.main(["build", "-s", "1901", "-e", "1903", "--wait", "0", "-o", out], spark) == 130
    assert list(json.load(open(out))["seasons"]) == ["1901"]
    calls[:] = [1, 1]
    assert cli.main(["build", "-s", "1901", "-e", "1903", "--update-only", "-o", out, "--pretty", "1"], spark) == 0
    assert list(json.load(open(out))["seasons"]) == ["1901", "1902", "1903"] and len(calls) == 4 and '\n "seasons"' in open(out).read()


def test_files_are_written_season_by_season_on_any_file_system(spark, tmp_path):
    data = datasets.from_literal(spark, json.dumps({"seasons": {"1950": {"tier1": [{"team": "Ä \"q\"", "notes": "a\nb"}]}, "abc": {"tier1": []}}}))
    for pretty in (True, 4, False):
        here, there = str(tmp_path / f"a{pretty}.json"), f"file://{tmp_path}/b{pretty}.json"
        sinks.save_json(data, here, pretty)
        sinks.save_json(data, there, pretty)
        text = open(here, encoding="utf-8").read()
        assert text == open(there.removeprefix("file://"), encoding="utf-8").read()
        spaces = 2 if pretty is True else pretty or None
        assert text == json.dumps(json.loads(text), ensure_ascii=False, indent=spaces, separators=None if spaces else (",", ":"))
    sinks.save_json(data.where(data.tiers["season_key"] == "none"), str(tmp_path / "none.json"))
    assert json.load(open(tmp_path / "none.json")) == {"seasons": {}}
    assert datasets.expand_targets([f"file://{tmp_path}/b*.json"], spark) == sorted(f"file:{tmp_path}/b{p}.json" for p in (True, 4, False))


def test_several_sources_give_a_folder(spark, tmp_path, capsys):
    text = "<pre>League - {0}\n\n P W D L F A W D L F A Pts\n 1. ONE 38 14 1 4 41 20 10 4 5 24 21 53\n</pre>"
    for year in ("1908/09", "1909/10"):
        (tmp_path / f"p{year[:4]}.html").write_text(text.format(year))
    out = str(tmp_path / "out")
    assert cli.main(["scrape", "-f", str(tmp_path / "p1908.html"), "-f", str(tmp_path / "p1909.html"), "-o", out], spark) == 0
    assert [list(json.load(open(f"{out}/p{y}.json"))["seasons"]) for y in (1908, 1909)] == [["1908"], ["1909"]]


def test_lint_sums_and_orders(spark, tmp_path, capsys):
    seasons = {"éa": {"tier1": []}, "zz": {"tier1": []}, "Ab": {"tier1": []}, "1951": {"tier2": [], "tier10": [{"team": "A"}], "tier1": [{"team": "B", "played": 3}]}, "1900": {"note": {}}}
    (tmp_path / "a.json").write_text(json.dumps({"seasons": seasons}))
    assert cli.main(["lint", str(tmp_path / "a.json"), "--fail-on-issues"], spark) == 1
    said = capsys.readouterr().out.splitlines()
    assert [x.split("] ")[1].split(":")[0] for x in said[1:-1]] == ["1900", "1951 tier1", "1951 tier2", "Ab", "éa", "zz"] and said[-1] == "6 issues in 5 seasons"
    assert cli.main(["lint-overview", "--json", json.dumps({"seasons": {"2008": {"tier1": {"table": []}}}}), "--odd"], spark) == 1
    told = capsys.readouterr()
    assert "1 seasons, 1 errors, 1 warnings" in told.out and "--odd" in told.err
    assert lint.summary(lint.lint(datasets.from_literal(spark, "{}"))) == {"issues": 0, "seasons": 0}


def test_other_addresses_come_first():
    asked = []

    def plain(url):
        asked.append(url)
        if "rest" in url:
            raise OSError
        return b"x", ""

    fetch = pages.first_of(pages.elsewhere(plain, pages.WIKI, pages.WIKI_HTML), plain)
    assert fetch(pages.WIKI + "A")[0] == b"x" and fetch("u")[0] == b"x" and asked == [pages.WIKI_HTML + "A", pages.WIKI + "A", "u"]


def test_year_of_labels(spark):
    rows = spark.createDataFrame([(["no", "1908/09", "1910"],), ([],), (None,), ([None, "x2001"],)], "a array<string>").select(labels_year("a").alias("y")).collect()
    assert [r["y"] for r in rows] == [1908, None, None, 2001]


def test_clashing_columns(spark):
    rows = spark.createDataFrame([("1", "1950", "x", 1, "f", "c")], "tier string, Season string, __form string, n int, form string, chunk string")
    assert sinks.with_chunks(rows).first()["chunk"] == "1950-1950" and sinks.with_chunks(rows).columns == ["tier", "Season", "__form", "n", "form", "chunk"]
    frame = spark.createDataFrame([(1, "A", 5, "p"), (2, "a", 6, "q")], "o int, v string, value int, place string")
    assert lint.duplicates(frame, [], frame["v"], "o", frame["v"].substr(9, 1)).count() == 1
    assert [(r["o"], r["first_row"]) for r in lint.with_first(frame.withColumnRenamed("place", "first_row"), [], frame["v"].substr(9, 1), "o").collect()] == [(2, 1)]
