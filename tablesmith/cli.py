"""Command line: build, overview, combined, scrape, combine, lint, lint-overview, minify, tables, split."""

from __future__ import annotations

import argparse
import os
import re
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.functions.league import labels_year
from tablesmith.operators import html, merge, seasons, standings, textpages
from tablesmith.operators import lint as rules
from tablesmith.operators.dataset import Dataset, replace, strict
from tablesmith.sources import datasets, matches, pages, sinks
from tablesmith.sources.store import SeasonStore


def session() -> SparkSession:
    return SparkSession.builder.appName("tablesmith").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _fetched(spark: SparkSession, wanted: DataFrame, args: argparse.Namespace, done: Callable[[DataFrame], object] | None = None) -> DataFrame:
    """Pages with html: of a table of pages if one is named, else of the network, a second apart, kept as they come; done gets them group by group."""
    if args.pages:
        got = pages.table_pages(wanted, spark.read.parquet(args.pages))
        if done:
            done(got)
        return got
    got, whole = pages.kept_pages(wanted, pages.wiki_fetcher(os.environ.get("WIKIPEDIA_USER_AGENT", "tablesmith")), args.keep_pages or f"{args.output}.pages", args.wait, done=done)
    if not whole:
        print("interrupted: saving the seasons fetched so far", file=sys.stderr)
        args.interrupted = True
    return got


def _store(spark: SparkSession, args: argparse.Namespace) -> SeasonStore:
    return SeasonStore(spark, args.keep_seasons or f"{args.output}.seasons")


def _stored(spark: SparkSession, args: argparse.Namespace) -> tuple[Dataset, DataFrame]:
    """The seasons of the output, and over them those that a build has left in the store when it was stopped."""
    have = replace(datasets.load(spark, args.output), _store(spark, args).load(), ("season_key",))
    years = pages.season_years(spark, args.start, args.end)
    return have, years


def build(spark: SparkSession, args: argparse.Namespace, years: DataFrame | None = None) -> None:
    """Seasons of division pages; a season is replaced whole, unless its page gave no rows. Seasons are stored as their pages come."""
    have, own = _stored(spark, args)
    wanted = seasons.seasons_to_fetch(own if years is None else years, have, args.update_only, args.force_update, args.ignore_war_years, any_tier=False)
    store = _store(spark, args)

    def put(got: DataFrame) -> None:
        got = got.cache()
        rows = html.division_rows(got, ["season"]).cache()
        kept = got.join(rows.select("season").distinct(), "season", "left_semi") if args.force_update else got
        store.save(seasons.promotion_seasons(kept.select("season", "slug"), rows))
        got.unpersist(), rows.unpersist()

    _fetched(spark, pages.promotion_pages(wanted), args, put)
    _publish(spark, args, store)


def overview(spark: SparkSession, args: argparse.Namespace, years: DataFrame | None = None) -> None:
    """Seasons of overview pages, with all their tables as tiers. Seasons are stored as their pages come."""
    have, own = _stored(spark, args)
    wanted = seasons.seasons_to_fetch(own if years is None else years, have, args.update_only, args.force_update, args.ignore_war_years)
    store = _store(spark, args)

    def put(got: DataFrame) -> None:
        got = got.cache()
        rows = html.overview_rows(got, ["season_key"]).cache()
        tables = rows.select("season_key", "table_no", "title", "heading_id", "table_index", "is_top_flight").distinct()
        found = got.join(rows.select("season_key").distinct(), "season_key", "left_semi").select("season", "season_key", "slug")
        store.save(seasons.overview_seasons(found, tables, rows))
        got.unpersist(), rows.unpersist()

    _fetched(spark, pages.overview_pages(wanted), args, put)
    _publish(spark, args, store)


def _publish(spark: SparkSession, args: argparse.Namespace, store: SeasonStore) -> None:
    """The output with the store's seasons in it; the store is emptied when that is written."""
    have, _ = _stored(spark, args)
    save(have, args)
    store.clear()


def combined(spark: SparkSession, args: argparse.Namespace) -> None:
    """build, then overview for all seasons if forced, else for those that have no tier 1 rows."""
    build(spark, args)
    if args.interrupted:
        return
    have, years = _stored(spark, args)
    if not args.force_update:
        done = have.tiers.filter("tier_key = 'tier1' and n_rows > 0").select(F.col("season_num").alias("season")).distinct()
        years = years.join(done, "season", "left_anti")
    overview(spark, args, years)


def scrape(spark: SparkSession, args: argparse.Namespace) -> int:
    """Fixed-column pages of URLs, files and a range of seasons, as one dataset."""
    if (args.start is None) != (args.end is None):
        print("both the first and the last season are needed", file=sys.stderr)
        return 1
    sources = []
    if args.url:
        wanted = spark.createDataFrame([(u,) for u in args.url], "url string").select(F.lit(None).cast("int").alias("season"), F.lit(None).cast("string").alias("season_slug"), "url")
        sources.append(_fetched(spark, wanted, args).select("season", "season_slug", "url", "html"))
    if args.start is not None:
        sources.append(_fetched(spark, pages.season_urls(pages.season_years(spark, args.start, args.end), args.url_template), args).select("season", "season_slug", "url", "html"))
    if args.file:
        local = pages.local_pages(spark, args.file)
        sources.append(local.select(F.lit(None).cast("int").alias("season"), F.lit(None).cast("string").alias("season_slug"), F.col("path").alias("url"), "html"))
    if not sources:
        print("no page was named", file=sys.stderr)
        return 1
    got = reduce(DataFrame.unionByName, sources).withColumnRenamed("url", "page_id").cache()
    heads, rows = textpages.competitions(html.text_blocks(got, ["page_id"]))
    own = textpages.page_seasons(heads).withColumn("own_year", labels_year(F.col("seasons")))
    years = got.select("page_id", "season", F.col("season_slug").alias("wanted")).join(own, "page_id")
    years = years.select("page_id", F.coalesce("season", "own_year").alias("season"), F.coalesce("wanted", "season_slug").alias("season_slug"))
    if args.save_html:
        sinks.save_pages(got.select(F.coalesce("season_slug", F.md5("page_id")).alias("slug"), "html"), args.save_html)
    ids = [*(args.url or []), *(r["page_id"] for r in got.select("page_id").collect() if args.file)] if args.start is None else []
    if len(set(ids)) < 2:
        save(seasons.text_seasons(heads, rows, years), args)
        return 0
    print("several sources: the output is a folder with a file for each", file=sys.stderr)
    for page in sorted(set(ids)):
        own_page = F.col("page_id") == page
        name = re.sub(r"[^\w.-]+", "-", os.path.splitext(page.rstrip("/").rsplit("/", 1)[-1])[0]) or "page"
        save(seasons.text_seasons(heads.filter(own_page), rows.filter(own_page), years.filter(own_page)), args, f"{args.output}/{name}.json")
    return 0


def save(data: Dataset, args: argparse.Namespace, path: str | None = None) -> None:
    sinks.save_json(Dataset(data.tiers, strict(data.entries)), path or args.output, False if args.compact else args.pretty)


def combine(spark: SparkSession, args: argparse.Namespace) -> None:
    data, figures = merge.combine([datasets.load(spark, p, "error") for p in args.inputs], args.include_empty)
    save(data, args)
    row = figures.first()
    print(row.asDict())
    for row in merge.missing_by_war(spark.createDataFrame([row], figures.schema)).collect():
        print(f"missing, {row['bucket']}: {', '.join(map(str, row['seasons']))}")


def lint(spark: SparkSession, args: argparse.Namespace) -> int:
    code = 0
    for path in datasets.expand_targets(args.targets, spark):
        issues = rules.lint(datasets.load(spark, path), args.raw_differences).cache()
        found = rules.summary(issues)
        print(path)
        for line in sinks.told_issues(issues):
            print(line)
        print(f"{found['issues']} issues in {found['seasons']} seasons")
        code |= sinks.exit_code(issues, args.fail_on_issues)
    return code


def lint_overview(spark: SparkSession, args: argparse.Namespace) -> int:
    raw = datasets.raw_literal(spark, args.json) if args.json else datasets.raw_dataset(spark, args.file, "error")
    issues = rules.lint_overview(raw).cache()
    if raw.isEmpty():
        print('<all> error: Missing top-level "seasons" object')
        return 1
    for r in issues.orderBy("season_key", "place").toLocalIterator():
        print(f"{r['season_key']} {r['severity']}: {r['message']}")
    found = rules.summary(issues)
    print(f"{raw.select('season_key').distinct().count()} seasons, {found['errors']} errors, {found['warnings']} warnings")
    return sinks.exit_code(issues)


def tables(spark: SparkSession, args: argparse.Namespace) -> None:
    table = standings.league_table(matches.as_matches(matches.read_csv(spark, args.inputs)))
    table.write.mode("overwrite").parquet(f"{args.output}/tables")
    standings.movements(table).write.mode("overwrite").parquet(f"{args.output}/movements")


def split(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = matches.read_csv(spark, args.inputs)
    (sinks.save_chunks if args.chunks else sinks.save_by_tier)(rows, args.output, order=("file", "row_ord"))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tablesmith")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, start: int | None = None, end: int | None = None) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        if name in ("build", "overview", "combined", "scrape"):
            p.add_argument("-s", "--start", type=int, default=start)
            p.add_argument("-e", "--end", type=int, default=end)
            p.add_argument("--pages", default=os.environ.get("TABLESMITH_PAGES"), help="Parquet table (url, html) to read pages from; by default that of TABLESMITH_PAGES, if set, else the network")
            p.add_argument("--wait", type=float, default=1.0)
            p.add_argument("--keep-pages", help="folder that fetched pages are kept in and not fetched again from; by default beside the output")
        if name in ("build", "overview", "combined"):
            p.add_argument("--keep-seasons", help="folder that seasons are stored in until the output is written; by default beside the output")
            for flag in ("--update-only", "--force-update", "--ignore-war-years"):
                p.add_argument(flag, action="store_true")
        return p

    for name, start, end, output in (("build", 1888, 2000, "promotion_seasons.json"), ("overview", 2008, 2008, "overview_seasons.json"), ("combined", 1888, 2000, "combined_seasons.json"), ("scrape", None, None, "text_seasons.json")):
        p = command(name, start, end)
        p.add_argument("-o", "--output", default=f"data-output/{output}")
        p.add_argument("--compact", action="store_true")
        p.add_argument("--pretty", type=int, default=2, metavar="SPACES")
        if name == "scrape":
            p.add_argument("-u", "--url", action="append")
            p.add_argument("-f", "--file", action="append")
            p.add_argument("--url-template", default=pages.DEFAULT_TEMPLATE)
            p.add_argument("--save-html")
    p = command("combine")
    p.add_argument("inputs", nargs="+")
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--include-empty", action="store_true")
    p.add_argument("--compact", action="store_true")
    p.add_argument("--pretty", type=int, default=2, metavar="SPACES")
    p = command("lint")
    p.add_argument("targets", nargs="+")
    p.add_argument("--fail-on-issues", action="store_true")
    p.add_argument("--raw-differences", action="store_true")
    p = command("lint-overview")
    p.add_argument("-f", "--file")
    p.add_argument("-j", "--json")
    p = command("minify")
    p.add_argument("inputs", nargs="+")
    p.add_argument("-i", "--in-place", action="store_true")
    p.add_argument("-s", "--suffix", default=".min")
    for name in ("tables", "split"):
        p = command(name)
        p.add_argument("inputs", nargs="+")
        p.add_argument("-o", "--output", required=True)
        if name == "split":
            p.add_argument("--chunks", action="store_true")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args, unknown = parser().parse_known_args(argv)
    if unknown and args.command == "lint-overview":
        print(f"unknown arguments are ignored: {' '.join(unknown)}", file=sys.stderr)
    elif unknown:
        parser().error(f"unrecognized arguments: {' '.join(unknown)}")
    args.interrupted = False
    if args.command == "minify":
        for path in args.inputs:
            print(sinks.minify(spark or session(), path, args.in_place, args.suffix))
        return 0
    code = globals()[args.command.replace("-", "_")](spark or session(), args) or 0
    return 130 if args.interrupted else code


if __name__ == "__main__":
    sys.exit(main())
