"""Seasons put together from extracted tables: which tables are the major tiers, and what moved between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.league import begins_with_numbered_tier, war_season_of_fetch
from tablesmith.operators.dataset import FLAGS, Dataset, normalise

WIKI = "https://en.wikipedia.org/wiki/"
#: Columns of an extracted row with the published names of their fields.
FIELDS = {
    "pos": "pos", "team": "team", "played": "played", "won": "won", "drawn": "drawn", "lost": "lost", "goals_for": "goalsFor", "goals_against": "goalsAgainst",
    "goal_difference": "goalDifference", "goal_average": "goalAverage", "points": "points", "notes": "notes", **{v: k for k, v in FLAGS.items()},
}


def major_tiers(tables: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., top_index, second_index) of tables(keys..., table_no, is_top_flight, n_rows).

    The first top flight, else the first table; then the next later table with rows, if any.
    """
    top = F.coalesce(F.min(F.when(F.col("is_top_flight"), F.col("table_no"))), F.lit(0))
    later = F.array_sort(F.collect_list(F.when(F.col("n_rows") > 0, F.col("table_no"))))
    found = tables.groupBy(*keys).agg(top.alias("top_index"), later.alias("_filled"))
    return found.select(*keys, "top_index", F.array_min(F.filter("_filled", lambda i: i > F.col("top_index"))).alias("second_index"))


def outcome_teams(rows: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """(keys..., teams): different teams with the flag, by table and row."""
    listed = F.array_sort(F.collect_list(F.struct("table_no", "row_ord", "team")))
    return rows.filter(F.col(flag) & F.col("team").isNotNull()).groupBy(*keys).agg(F.array_distinct(F.transform(listed, lambda r: r["team"])).alias("teams"))


def _row_json(rows: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(c).alias(name) for c, name in FIELDS.items() if c in rows.columns]), {"ignoreNullFields": "false"})


def _tables(rows: DataFrame, keys: list[str]) -> DataFrame:
    lines = F.transform(F.array_sort(F.collect_list(F.struct("row_ord", _row_json(rows).alias("line")))), lambda r: r["line"])
    return rows.groupBy(*keys).agg(F.concat(F.lit("["), F.array_join(lines, ","), F.lit("]")).alias("table"))


def _object(*parts: tuple[str, Column]) -> Column:
    """JSON of an object whose values are JSON already."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{name}":'), value) for name, value in parts]), F.lit("}"))


def _list(names: Column) -> Column:
    return F.to_json(F.coalesce(names, F.array().cast("array<string>")))


def _text(value: Column) -> Column:
    whole = F.to_json(F.array(value))
    return F.when(value.isNull(), "null").otherwise(whole.substr(F.lit(2), F.length(whole) - 2))


def promotion_seasons(pages: DataFrame, rows: DataFrame) -> Dataset:
    """Seasons of pages(season, slug) with rows(season, division, row_ord, fields): two divisions a page.

    Promotion comes from the second division and relegation from the first, both told in seasonInfo; the first
    division's own list of promoted stays empty. A second division without rows is left out.
    """
    number = rows.withColumn("table_no", F.when(F.col("division") == "first", 1).otherwise(2))
    up = outcome_teams(number.filter("table_no = 2"), ["season"], "was_promoted").withColumnRenamed("teams", "up")
    down = outcome_teams(number.filter("table_no = 1"), ["season"], "was_relegated").withColumnRenamed("teams", "down")
    tables = _tables(number, ["season", "table_no"])
    by_no = lambda n: tables.filter(f"table_no = {n}").select("season", F.col("table").alias(f"table{n}"))
    whole = pages.join(up, "season", "left").join(down, "season", "left").join(by_no(1), "season", "left").join(by_no(2), "season", "left")
    season, url = F.col("season").cast("string"), F.concat(F.lit(WIKI), "slug")
    about = [("seasonSlug", _text(F.col("slug"))), ("sourceUrl", _text(url))]
    info = _object(("season", season), ("table", F.lit("[]")), ("promoted", _list(F.col("up"))), ("relegated", _list(F.col("down"))), *about)
    tier = lambda n: _object(("season", season), ("table", F.coalesce(f"table{n}", F.lit("[]"))), *about, ("tier", F.lit(f'"tier{n}"')))
    blocks = F.array(F.struct(F.lit("seasonInfo").alias("k"), info.alias("v")), F.struct(F.lit("tier1").alias("k"), tier(1).alias("v")), F.struct(F.when(F.col("table2").isNotNull(), "tier2").alias("k"), tier(2).alias("v")))
    data = normalise(_raw(whole.select(season.alias("season_key"), F.posexplode(blocks).alias("tier_ord", "b"))))
    blank = F.array().cast("array<string>")
    return Dataset(data.tiers.withColumn("promoted", F.when(F.col("tier_key") == "tier1", blank).otherwise(F.col("promoted"))), data.entries)


def overview_seasons(pages: DataFrame, tables: DataFrame, rows: DataFrame) -> Dataset:
    """Seasons of pages(season, season_key, slug) with tables(season_key, table_no, title, heading_id, table_index, is_top_flight) and rows(season_key, table_no, row_ord, fields).

    Every table is a tier, in order. seasonInfo tells promotion from the second tier, relegation from the top flight,
    and how many tables there are.
    """
    counted = tables.join(rows.groupBy("season_key", "table_no").agg(F.count("*").alias("n_rows")), ["season_key", "table_no"], "left").fillna({"n_rows": 0})
    major = major_tiers(counted, ["season_key"])
    of = lambda index, flag, name: outcome_teams(rows.join(major.select("season_key", F.col(index).alias("table_no")), ["season_key", "table_no"]), ["season_key"], flag).withColumnRenamed("teams", name)
    size = tables.groupBy("season_key").agg(F.count("*").alias("n_tables"))
    whole = pages.join(of("second_index", "was_promoted", "up"), "season_key", "left").join(of("top_index", "was_relegated", "down"), "season_key", "left").join(size, "season_key", "left").fillna({"n_tables": 0})
    season = F.coalesce("season", F.lit(0)).cast("string")
    about, n = ("seasonSlug", _text(F.col("slug"))), ("tableCount", F.col("n_tables").cast("string"))
    info = _object(("season", season), ("table", F.lit("[]")), ("promoted", _list(F.col("up"))), ("relegated", _list(F.col("down"))), about, n)
    infos = whole.select("season_key", F.lit(0).alias("tier_ord"), F.struct(F.lit("seasonInfo").alias("k"), info.alias("v")).alias("b"))
    meta = _object(("leagueId", _text(F.col("heading_id"))), ("tableIndex", F.col("table_index").cast("string")), n, about)
    held = tables.join(_tables(rows, ["season_key", "table_no"]), ["season_key", "table_no"], "left").join(whole, "season_key")
    tier = _object(("season", season), ("table", F.coalesce("table", F.lit("[]"))), ("title", _text(F.col("title"))), ("seasonMetadata", meta))
    tiers = held.select("season_key", (F.col("table_no") + 1).alias("tier_ord"), F.struct(F.concat(F.lit("tier"), (F.col("table_no") + 1).cast("string")).alias("k"), tier.alias("v")).alias("b"))
    return normalise(_raw(infos.unionByName(tiers)))


def text_seasons(heads: DataFrame, rows: DataFrame, years: DataFrame) -> Dataset:
    """Seasons of fixed-column pages: heads and rows of competitions(), years(page_id, season, season_slug).

    A page's first competition is tier 1 with lists of who moved, the others are bare tables. The key is the year, else
    the slug; pages with neither fall away.
    """
    order = F.expr("cast(row_number() over (partition by page_id order by block_no) - 1 as int)")
    placed = heads.withColumn("table_no", order).select("page_id", "block_no", "table_no")
    own = rows.join(placed, ["page_id", "block_no"])
    keyed = years.withColumn("season_key", F.coalesce(F.col("season").cast("string"), "season_slug")).filter("season_key is not null")
    lists = [outcome_teams(own.filter("table_no = 0"), ["page_id"], f"was_{s}").withColumnRenamed("teams", s) for s in ("promoted", "relegated")]
    whole = _tables(own, ["page_id", "table_no"]).join(keyed, "page_id").join(lists[0], "page_id", "left").join(lists[1], "page_id", "left")
    first = _object(("season", F.coalesce(F.col("season").cast("string"), F.lit("null"))), ("table", F.col("table")), ("relegated", _list(F.col("relegated"))), ("promoted", _list(F.col("promoted"))))
    block = F.struct(F.concat(F.lit("tier"), (F.col("table_no") + 1).cast("string")).alias("k"), F.when(F.col("table_no") == 0, first).otherwise(F.col("table")).alias("v"))
    return normalise(_raw(whole.select("season_key", F.col("table_no").alias("tier_ord"), block.alias("b"))))


def _raw(blocks: DataFrame) -> DataFrame:
    """Raw tiers of blocks(season_key, tier_ord, b struct<k, v>); blocks without a name fall away."""
    order = F.coalesce(F.col("season_key").try_cast("int"), F.lit(1 << 30))
    return blocks.filter("b.k is not null").select(F.lit(0).alias("source_rank"), "season_key", order.alias("season_ord"), F.col("b.k").alias("tier_key"), F.col("tier_ord").cast("int").alias("tier_ord"), F.col("b.v").alias("tier_json"))


def seasons_to_fetch(years: DataFrame, have: Dataset | None, update_only: bool = False, force: bool = False, skip_war: bool = False, any_tier: bool = True) -> DataFrame:
    """years(season) that need fetching, told before anything is fetched.

    update_only drops seasons with a table in a numbered tier (any_tier) or in tier 1 or 2, unless force; skip_war
    drops seasons of the wars.
    """
    if have is not None and update_only and not force:
        tier = begins_with_numbered_tier(F.col("tier_key")) if any_tier else F.col("tier_key").isin("tier1", "tier2")
        done = have.tiers.filter(tier & (F.col("n_rows") > 0)).select(F.col("season_num").alias("season")).distinct()
        years = years.join(done, "season", "left_anti")
    return years.filter(~war_season_of_fetch(F.col("season"))) if skip_war else years
