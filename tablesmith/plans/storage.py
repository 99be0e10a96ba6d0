"""Registered queries of stores, published files, comparisons and SQL's table functions, over the league tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesmith.operators import compare, html_functions
from tablesmith.operators.dataset import Dataset, normalise
from tablesmith.plans.assembly import _gathered, _raw, _sized
from tablesmith.plans.queries import _NOTE, _OUT, _SIDES, _TITLES, _noted, _pages, query
from tablesmith.sources import json_ranges, sinks
from tablesmith.sources.shared import shared_folder
from tablesmith.sources.store import SeasonStore

_FIELDS = {"pos": "pos", "team": "team", "won": "won", "goalsFor": "goals_for", "goalsAgainst": "goals_against", "points": "points"}


def _dataset(rows: DataFrame) -> Dataset:
    """Rows of league tables as a dataset of bare tables."""
    line = F.to_json(F.struct(*[F.col(c).alias(k) for k, c in _FIELDS.items()]))
    tiers = rows.groupBy("season", "tier").agg(_gathered(F.struct(F.col("pos").alias("o"), line.alias("line"))).alias("tier_json"))
    return normalise(_raw(tiers.select("season", F.concat(F.lit("tier"), "tier").alias("tier_key"), F.col("tier").alias("tier_ord"), "tier_json")))


def _counts(data: Dataset) -> DataFrame:
    return data.entries.groupBy("season_key", "tier_key").agg(F.count("*").alias("n_rows"), F.sum("goals_for").alias("goals"), F.sum(F.col("pos") * F.col("points")).alias("checksum"))


_COUNTED = "cast(season as varchar) as season_key, concat('tier', tier) as tier_key, count(*) as n_rows, cast(sum(goals_for) as double) as goals, cast(sum(pos * points) as double) as checksum"


@query(f"with {_SIDES} select {_COUNTED} from ranked where season % 3 = 0 or (season % 3 < 2 and season % 3 > 0 and tier = 1) or (season % 3 = 2 and tier = 1) group by season, tier")
def stored_seasons(spark, sf_dir):
    """A store after two builds of which each had a part of the seasons: where both have one, it is the second's, whole."""
    rows = _sized(spark, sf_dir)
    store = SeasonStore(spark, shared_folder(spark, "seasons"))
    store.save(_dataset(rows.filter("season % 3 < 2")))
    store.save(_dataset(rows.filter("season % 3 > 0 and tier = 1")))
    return _counts(store.load())


@query(f"with {_SIDES} select {_COUNTED} from ranked group by season, tier")
def published_seasons(spark, sf_dir):
    """A dataset published as one file by all tasks, and read back in ranges."""
    path = f"{shared_folder(spark, 'published')}/seasons.json"
    sinks.save_json(_dataset(_sized(spark, sf_dir)), path)
    return _counts(normalise(json_ranges.read_ranges(spark, path).withColumn("source_rank", F.lit(0))))


@query(f"with {_SIDES} select tier, row_number() over (partition by tier order by season, pos) as place, season, team, cast(points as bigint) as points from ranked")
def ordered_csv(spark, sf_dir):
    """CSV files of a tier read one after the other, by name: the order in which rows were given."""
    folder = shared_folder(spark, "tiers")
    sinks.save_by_tier(_sized(spark, sf_dir).select("tier", "season", "team", "points", F.col("season").alias("o1"), F.col("pos").alias("o2")), folder, ("o1", "o2"), rows_a_file=50)
    read = spark.read.schema("season int, team string, points long, tier int").option("header", True).csv(folder)
    placed = read.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    place = F.row_number().over(Window.partitionBy("tier").orderBy("file", "start", "line")).cast("long")
    return placed.select("tier", place.alias("place"), "season", "team", "points")


_CHANGED = f"""{_SIDES},
  a as (select season, tier, team, pos, won, points from ranked),
  b as (select season, tier, team, pos, won, if(season % 7 = 0 and pos = 1, points + 1, points) as points from ranked where not (season % 5 = 0 and pos = 2) and season <> 1999
    union all select season, tier, team, pos, won, points from ranked where season % 11 = 0 and pos = 3 and season <> 1999
    union all select season + 1000, tier, team, pos, won, points from ranked where season % 13 = 0),
  gone as (select season, tier, team, count(*) as n from (select * from a except all select * from b) group by all),
  come as (select season, tier, team, count(*) as n from (select * from b except all select * from a) group by all),
  told_of as (select coalesce(g.season, c.season) as season, coalesce(g.tier, c.tier) as tier, coalesce(g.team, c.team) as team, coalesce(g.n, 0) as g, coalesce(c.n, 0) as c
    from gone g full join come c on g.season = c.season and g.tier = c.tier and g.team = c.team)"""


@query(f"""with {_CHANGED}, told as (
  select season, tier, team, 'changed' as change, 'points' as fields, least(g, c) as copies from told_of
  union all select season, tier, team, 'removed', null, g - least(g, c) from told_of
  union all select season, tier, team, 'added', null, c - least(g, c) from told_of)
  select cast(season as varchar) as season_key, concat('tier', tier) as tier_key, team, change, fields, cast(copies as bigint) as copies from told where copies > 0""")
def dataset_changes(spark, sf_dir):
    """What makes one dataset another: points changed, rows gone, rows come, rows repeated."""
    rows = _sized(spark, sf_dir)
    points = F.when((F.col("season") % 7 == 0) & (F.col("pos") == 1), F.col("points") + 1).otherwise(F.col("points"))
    other = rows.filter("not (season % 5 = 0 and pos = 2) and season <> 1999").withColumn("points", points)
    more = rows.filter("season % 11 = 0 and pos = 3 and season <> 1999").unionByName(rows.filter("season % 13 = 0").withColumn("season", F.col("season") + 1000))
    found = compare.diff(_dataset(rows).entries, _dataset(other.unionByName(more)).entries)
    return found.select("season_key", "tier_key", "team", "change", F.array_join("fields", ",").alias("fields"), "copies")


@query(f"""with {_SIDES}, a as (select distinct season, tier from ranked where season % 2 = 0 or tier = 1), b as (select distinct season, tier from ranked where season % 3 = 0 or tier = 2)
  select cast(season as varchar) as season_key, concat('tier', tier) as tier_key, case when (season, tier) in (from a) and (season, tier) in (from b) then 'both' when (season, tier) in (from a) then 'left' else 'right' end as side
  from (from a union from b)""")
def shared_tiers(spark, sf_dir):
    """Which tiers two datasets have, and which only one of them."""
    rows = _sized(spark, sf_dir)
    return compare.shared_tiers(_dataset(rows.filter("season % 2 = 0 or tier = 1")).tiers, _dataset(rows.filter("season % 3 = 0 or tier = 2")).tiers)


def _view(spark: SparkSession, pages: DataFrame, name: str) -> None:
    html_functions.register(spark)
    pages.createOrReplaceTempView(name)


@query(f"""with {_SIDES} select season, case when tier = 1 then 'first' else 'second' end as division, cast(pos - 1 as int) as row_ord, {_OUT}, {_NOTE} as notes,
  pos > size - 2 and pos > 1 as was_relegated, tier = 2 and pos = 1 as was_promoted from ranked""")
def sql_division_tables(spark, sf_dir):
    """Division pages parsed in SQL alone."""
    wrap = """concat('<div><span class="mw-headline" id="', if(tier = 1, 'First', 'Second'), '_Division">x</span></div>')"""
    _view(spark, _pages(_noted(spark, sf_dir), _TITLES, wrap), "tablesmith_division_pages")
    return spark.sql("select season, division, row_ord, pos, team, played, won, goals_for, points, notes, was_relegated, was_promoted from tablesmith_division_pages, lateral parse_division(html)")


@query(f"""with {_SIDES}, t as (select distinct season, tier from ranked), n as (select *, cast(row_number() over (partition by season order by tier) - 1 as int) as table_no from t)
  select r.season, n.table_no, case when r.tier = 1 then 'Premier League' else 'Second Division' end as title, r.tier = 1 as is_top_flight, {_OUT}, {_NOTE} as notes, r.tier = 2 and pos = 1 as was_promoted
  from ranked r join n on n.season = r.season and n.tier = r.tier""")
def sql_overview_tables(spark, sf_dir):
    """Overview pages parsed in SQL alone."""
    wrap = """concat('<div class="mw-heading mw-heading3"><h3 id="t', tier, '">', if(tier = 1, 'Premier League', 'Second Division'), '</h3></div>')"""
    _view(spark, _pages(_noted(spark, sf_dir), _TITLES, wrap), "tablesmith_overview_pages")
    whole = """concat('<div class="mw-heading mw-heading2"><h2 id="League_tables">League tables</h2></div>', html)"""
    return spark.sql(f"select season, table_no, title, is_top_flight, pos, team, played, won, goals_for, points, notes, was_promoted from tablesmith_overview_pages, lateral parse_overview({whole})")


@query(f"""with {_SIDES} select season, cast(tier - 1 as int) as block_no, concat('|', string_agg(concat(pos, ' ', team, ' ', points), '|' order by pos)) as text from ranked group by season, tier""")
def sql_text_blocks(spark, sf_dir):
    """Pre-formatted blocks of pages, in SQL alone."""
    line = F.concat_ws(" ", F.col("pos").cast("string"), "team", F.col("points").cast("string"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda r: r["line"]), "|")
    tables = _sized(spark, sf_dir).groupBy("season", "tier").agg(F.concat(F.lit("<p>x</p><pre>|"), lines, F.lit("</pre>")).alias("html"))
    pages = tables.groupBy("season").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tier", "html"))), lambda r: r["html"]), "").alias("html"))
    _view(spark, pages, "tablesmith_text_pages")
    return spark.sql("select season, block_no, text from tablesmith_text_pages, lateral parse_blocks(html)")
