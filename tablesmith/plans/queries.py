"""Registered queries over the standard tables, each with its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesmith.functions import league
from tablesmith.functions.js import js_number, js_parse_float, js_parse_int, js_trim
from tablesmith.operators import html, lint, merge, standings, textpages
from tablesmith.operators.dataset import normalise, raw_tiers
from tablesmith.operators.legends import legend_flags
from tablesmith.operators.seasons import major_tiers
from tablesmith.operators.textpages import table_rows
from tablesmith.plans.matches import SQL as MATCHES
from tablesmith.plans.matches import matches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# League tables and what follows from them.

_SIDES = f"""
m as ({MATCHES}),
sides as (
  select season, tier, match_ord, 0 as side, home as team, hgoal as gf, vgoal as ga, result, 'H' as win from m
  union all select season, tier, match_ord, 1, visitor, vgoal, hgoal, result, 'A' from m
),
totals as (
  select season, tier, team, count(*) as played, sum(case when result = win then 1 else 0 end) as won, sum(case when result = 'D' then 1 else 0 end) as draw,
    sum(case when result in ('H', 'A') and result <> win then 1 else 0 end) as lost, sum(gf) as goals_for, sum(ga) as goals_against, min(match_ord * 2 + side) as first_seen
  from sides group by season, tier, team
),
scored as (
  select *, won * (case when season <= 1980 then 2 else 3 end) + draw as points, goals_for - goals_against as goal_difference,
    case when goals_against = 0 then cast(goals_for as double) else cast(goals_for as double) / goals_against end as goal_average from totals
),
ranked as (
  select *, row_number() over (partition by season, tier order by points desc, case when season <= 1975 then goal_average else cast(goal_difference as double) end desc, goals_for desc, first_seen) as pos,
    count(*) over (partition by season, tier) as size from scored
)"""


@query(f"""with {_SIDES} select season, tier, team, cast(played as bigint) as played, cast(won as bigint) as won, cast(draw as bigint) as draw, cast(lost as bigint) as lost,
  cast(goals_for as bigint) as goals_for, cast(goals_against as bigint) as goals_against, cast(points as bigint) as points, cast(goal_difference as bigint) as goal_difference, goal_average, cast(pos as int) as pos from ranked""")
def league_table(spark, sf_dir):
    return standings.league_table(matches(spark, sf_dir))


@query(f"""with {_SIDES} select season, tier, 'top' as bucket, cast(pos as int) as place, team from ranked where pos <= 4
  union all select season, tier, 'bottom', cast(pos - greatest(size - 4, 0) as int), team from ranked where pos > greatest(size - 4, 0)""")
def league_top4_bottom4(spark, sf_dir):
    return standings.ends(standings.league_table(matches(spark, sf_dir)))


_DOWN = "case when season <= 1897 then 0 when season <= 1980 then 2 when season <= 1991 then 3 when season = 1995 then 4 else 3 end"
_UP = "case when season <= 1897 then 0 when season <= 1980 then 2 when season <= 1991 then 3 when season = 1995 then 2 else 3 end"


@query(f"""with {_SIDES}, moved as (
  select team, 0 as up, 1 as down from ranked where tier = 1 and size >= {_DOWN} and pos > size - {_DOWN}
  union all select team, 1, 0 from ranked where tier = 2 and size >= {_UP} and pos <= {_UP} and season in (select season from ranked where tier = 1))
  select team, cast(sum(up) as bigint) as promoted, cast(sum(down) as bigint) as relegated from moved group by team""")
def promotion_relegation_stats(spark, sf_dir):
    return standings.movements(standings.league_table(matches(spark, sf_dir)))


@query(f"""with m as ({MATCHES}), names as (select distinct trim(n) as name from (select home as n from m union all select visitor from m) where trim(n) <> '')
  select concat('club_', row_number() over (order by name)) as id, name from names""")
def club_ids(spark, sf_dir):
    return standings.club_ids(matches(spark, sf_dir))


@query(f"""with m as ({MATCHES}), s as (select distinct tier, season from m), d as (select tier, season, cast((dense_rank() over (partition by tier order by season) - 1) // 5 as int) as chunk from s)
  select tier, season, chunk, concat(min(season) over (partition by tier, chunk), '-', max(season) over (partition by tier, chunk)) as label from d""")
def season_chunks(spark, sf_dir):
    return standings.season_chunks(matches(spark, sf_dir), 5)


# Merging. Two sources are derived from the matches; some of their tiers are empty by construction.

_SOURCES = f"""
m as ({MATCHES}),
sources as (
  select 0 as source_rank, cast(season as varchar) as season_key, concat('tier', tier) as tier_key, count(*) filter (where season % 3 <> 0) as n from m group by season, tier
  union all select 1, cast(season + 2 as varchar), concat('tier', tier), count(*) filter (where season % 5 <> 0) from m where season % 2 = 0 group by season, tier
  union all select 2, cast(season as varchar), 'tier1', count(*) filter (where season % 7 = 0) from m group by season
)"""


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matches(spark, sf_dir)
    season, tier = F.col("season"), F.concat(F.lit("tier"), F.col("tier").cast("string"))
    one = m.groupBy("season", "tier").agg(F.count_if(season % 3 != 0).alias("n")).select(F.lit(0).alias("source_rank"), season.cast("string").alias("season_key"), tier.alias("tier_key"), "n")
    two = m.filter(season % 2 == 0).groupBy("season", "tier").agg(F.count_if(season % 5 != 0).alias("n")).select(F.lit(1).alias("source_rank"), (season + 2).cast("string").alias("season_key"), tier.alias("tier_key"), "n")
    three = m.groupBy("season").agg(F.count_if(season % 7 == 0).alias("n")).select(F.lit(2).alias("source_rank"), season.cast("string").alias("season_key"), F.lit("tier1").alias("tier_key"), "n")
    return one.unionByName(two).unionByName(three)


@query(f"""with {_SOURCES} select season_key, tier_key, source_rank from (
  select *, row_number() over (partition by season_key, tier_key order by (n > 0) desc, source_rank) as place from sources) where place = 1""")
def merge_first_wins(spark, sf_dir):
    return merge.first_wins(_sources(spark, sf_dir).withColumn("data", F.col("n") > 0))


@query(f"""with {_SOURCES}, folded as (select season_key, tier_key, source_rank, n, row_number() over (partition by season_key, tier_key order by source_rank) as k, count(*) over (partition by season_key, tier_key) as size,
  max(case when n = 0 then source_rank end) over (partition by season_key, tier_key) as last_empty, min(source_rank) over (partition by season_key, tier_key) as first_rank from sources),
  chosen as (select season_key, tier_key, first_rank, last_empty, min(case when n > 0 and source_rank > coalesce(last_empty, -1) then source_rank end) as data_after from folded group by all)
  select season_key, tier_key, cast(case when last_empty is null then first_rank when data_after is not null then data_after else last_empty end as int) as source_rank from chosen""")
def merge_include_empty(spark, sf_dir):
    return merge.first_wins(_sources(spark, sf_dir).withColumn("data", F.col("n") > 0), include_empty=True)


@query(f"with {_SOURCES} select season_key, max(source_rank) as source_rank from sources group by season_key")
def merge_last_wins(spark, sf_dir):
    return merge.last_wins(_sources(spark, sf_dir))


_JUDGED = f"""{_SOURCES}, judged as (select season_key, cast(season_key as int) as season, max(n) > 0 as data,
  cast(season_key as int) between 1915 and 1918 or cast(season_key as int) between 1940 and 1945 as war from sources group by season_key)"""


def _judged(sources: DataFrame) -> DataFrame:
    seasons = sources.groupBy("season_key").agg((F.max("n") > 0).alias("data")).withColumn("season", league.season_number(F.col("season_key")).cast("int"))
    return seasons.withColumn("war", league.war_season_of_merge(F.col("season")))


@query(f"""with {_JUDGED} select case when season between 1915 and 1918 then 'ww1' when season between 1940 and 1945 then 'ww2' else 'other' end as bucket, season from judged where not data""")
def missing_season_buckets(spark, sf_dir):
    missing = _judged(_sources(spark, sf_dir)).filter("not data").agg(F.array_sort(F.collect_list("season")).alias("missing_seasons"))
    return merge.missing_by_war(missing).select("bucket", F.explode("seasons").alias("season"))


@query(f"with m as ({MATCHES}) select season, count(*) as n from m where not (season between 1915 and 1918 or season between 1940 and 1945) group by season")
def war_year_filter(spark, sf_dir):
    return matches(spark, sf_dir).filter(~league.war_season_of_merge(F.col("season"))).groupBy("season").agg(F.count("*").alias("n"))


@query(f"with m as ({MATCHES}) select season, count(*) as n from m where not (season between 1915 and 1919 or season between 1940 and 1946) group by season")
def scrape_war_filter(spark, sf_dir):
    return matches(spark, sf_dir).filter(~league.war_season_of_fetch(F.col("season"))).groupBy("season").agg(F.count("*").alias("n"))


@query(f"with m as ({MATCHES}) select cast(y as int) as season from range(1888, 2025) t(y) where y not in (select season from m where tier = 1)")
def missing_season_fallback(spark, sf_dir):
    have = matches(spark, sf_dir).filter("tier = 1").select("season").distinct()
    return spark.range(1888, 2025).select(F.col("id").cast("int").alias("season")).join(have, "season", "left_anti")


# Scalars.

_WORD = "regexp_extract(text, '([^\\x20\\x09-\\x0D]+)', 1)"


@query("""select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as double), 0) as required, try_cast(nullif(json_extract_string(props, '$.k'), '') as double) as optional from events""")
def normalise_numbers(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    return read(spark, sf_dir, "events").select("event_id", league.required_number(k).alias("required"), league.optional_number(k).alias("optional"))


@query("""select doc_id, contains(n, 'relegat') or contains(n, 'demoted to the') as relegated, contains(n, 'promot') as promoted,
  contains(n, 'expansion') or contains(n, 'new club') or contains(n, 'admitted') or contains(n, 'joined league') as expansion, contains(n, 're-elected') as re_elected
  from (select doc_id, lower(replace(replace(text, 'ing', ' promoted'), 'ation', ' relegation')) as n from documents)""")
def normalise_notes_flags(spark, sf_dir):
    notes = F.replace(F.replace("text", F.lit("ing"), F.lit(" promoted")), F.lit("ation"), F.lit(" relegation"))
    docs = read(spark, sf_dir, "documents").select("doc_id", notes.alias("n"))
    flags = {"relegated": league.noted_relegated, "promoted": league.noted_promoted, "expansion": league.noted_expansion, "re_elected": league.noted_re_elected}
    return docs.select("doc_id", *[f(F.col("n")).alias(k) for k, f in flags.items()])


@query("select doc_id, trim(source) as notes from documents where source is not null and trim(source) <> ''")
def notes_extract(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", league.string_value(F.col("source")).alias("notes"))
    return docs.filter("notes is not null")


@query("""select lower(p_name) as form, arg_min(p_name, p_partkey) as value, min(p_partkey) as place, count(*) as n from (select *, p_brand as b from part) group by lower(p_name) having count(*) > 1""")
def duplicate_names(spark, sf_dir):
    parts = read(spark, sf_dir, "part").withColumn("form", F.lower("p_name"))
    return lint.duplicates(parts, ["form"], F.col("p_name"), "p_partkey", league.normal_name(F.col("p_name")))


@query("""select p_partkey, first_row from (select p_partkey, min(p_partkey) over (partition by p_brand, p_size) as first_row from part) where p_partkey > first_row""")
def duplicate_positions_with_pointer(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return lint.with_first(parts, ["p_brand"], F.col("p_size"), "p_partkey").select("p_partkey", "first_row")


_LISTED = f"""{_SIDES}, listed as (select distinct season, tier, upper(team) as team from ranked where pos % 3 = 0 union all select distinct season, tier, 'UNKNOWN FC' from ranked where season % 4 = 0)"""


@query(f"""with {_LISTED}
  select season, tier, team, 'missing' as kind from ranked r where pos <= 3 and not exists (select 1 from listed l where l.season = r.season and l.tier = r.tier and lower(l.team) = lower(r.team))
  union all select season, tier, team, 'unknown' from listed l where not exists (select 1 from ranked r where l.season = r.season and l.tier = r.tier and lower(l.team) = lower(r.team))""")
def outcome_antijoin(spark, sf_dir):
    table = standings.league_table(matches(spark, sf_dir))
    keys = table.select(F.lit(0).alias("source_rank"), F.col("season").cast("string").alias("season_key"), F.col("tier").cast("string").alias("tier_key"), (F.col("pos") - 1).alias("row_ord"), "team", (F.col("pos") <= 3).alias("was_promoted"), "season")
    names = F.array_agg(F.when((F.col("row_ord") + 1) % 3 == 0, F.upper("team")))
    extra = F.when(F.max("season") % 4 == 0, F.array(F.lit("UNKNOWN FC"))).otherwise(F.array().cast("array<string>"))
    tiers = keys.groupBy("source_rank", "season_key", "tier_key").agg(F.concat(names, extra).alias("promoted"))
    missing, unknown = lint.outcome_gaps(tiers, keys.drop("season"), "promoted")
    shape = lambda f, kind: f.select(F.col("season_key").cast("int").alias("season"), F.col("tier_key").cast("int").alias("tier"), "team", F.lit(kind).alias("kind"))
    return shape(missing, "missing").unionByName(shape(unknown, "unknown"))


@query(f"""with m as ({MATCHES}), t as (select distinct season, tier + case when season % 3 = 0 and tier = 2 then 1 else 0 end as n from m),
  r as (select season, n, row_number() over (partition by season order by n) as e from t)
  select cast(season as varchar) as season_key, string_agg(concat('tier', n), ', ' order by n) as found from r group by season having bool_or(n <> e)""")
def tier_sequence_check(spark, sf_dir):
    tier = F.col("tier") + F.when((F.col("season") % 3 == 0) & (F.col("tier") == 2), 1).otherwise(0)
    tiers = matches(spark, sf_dir).select(F.col("season").cast("string").alias("season_key"), F.concat(F.lit("tier"), tier.cast("string")).alias("tier_key")).distinct()
    return lint.tier_sequence(tiers, ["season_key"])


@query(f"""with m as ({MATCHES}) select cast(y as int) as season, concat(y, '-', case when (y + 1) % 100 = 0 then cast(y + 1 as varchar) else lpad(cast((y + 1) % 100 as varchar), 2, '0') end, '_Football_League') as promotion,
  concat(y, '–', case when (y + 1) % 100 = 0 then cast(y + 1 as varchar) else lpad(cast((y + 1) % 100 as varchar), 2, '0') end, '_in_English_football') as overview,
  concat(y, '-', lpad(cast((y + 1) % 100 as varchar), 2, '0')) as slug from (select distinct season as y from m)""")
def season_slug_generate(spark, sf_dir):
    years = matches(spark, sf_dir).select("season").distinct()
    y = F.col("season")
    return years.select("season", league.promotion_slug(y).alias("promotion"), league.overview_slug(y).alias("overview"), league.season_labels(y)["seasonSlug"].alias("slug"))


@query("""select doc_id, try_cast(nullif(regexp_extract(k, '^\\s*([+-]?\\d+)', 1), '') as bigint) as number, coalesce(nullif(regexp_extract(k, '(\\d{4})', 1), ''), k) as year
  from (select doc_id, case when doc_id % 3 = 0 then source else concat(1800 + doc_id % 250, '-', source) end as k from documents)""")
def season_key_parse(spark, sf_dir):
    key = F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise(F.concat((F.col("doc_id") % 250 + 1800).cast("string"), F.lit("-"), "source"))
    docs = read(spark, sf_dir, "documents").select("doc_id", key.alias("k"))
    return docs.select("doc_id", league.season_number(F.col("k")).alias("number"), league.slug_season_key(F.col("k")).alias("year"))


@query("""with spans as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, case when l_linenumber % 3 = 1 then l_returnflag end as note, case when l_linenumber % 3 = 1 then 1 + cast(l_quantity as int) % 3 end as span from lineitem),
  carried as (select *, last_value(note ignore nulls) over w as last_note, last_value(span ignore nulls) over w as last_span, max(case when span is not null then l_linenumber end) over w as opened from spans
  window w as (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice rows unbounded preceding))
  select l_orderkey, l_linenumber, l_partkey, case when l_linenumber < opened + last_span then last_note end as note from carried""")
def rowspan_carry(spark, sf_dir):
    """Notes that span rows, carried down as a set-based scan."""
    opens = F.col("l_linenumber") % 3 == 1
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", *order, F.when(opens, F.col("l_returnflag")).alias("note"), F.when(opens, 1 + F.col("l_quantity").cast("int") % 3).alias("span"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", standings.carried(["l_orderkey"], order, "note", "span").alias("note"))


@query("""select o_orderkey, cast(o_orderkey % 90 + 1 as bigint) as pos, concat('TEAM ', o_custkey % 50) as team, cast(p as bigint) as played, cast(a + h as bigint) as goals_for, cast(b + v as bigint) as goals_against, cast(pts as bigint) as points
  from (select *, o_orderkey % 42 as p, o_orderkey % 60 as h, o_custkey % 60 as v, o_custkey % 31 as a, o_orderkey % 37 as b, o_custkey % 99 as pts from orders)""")
def pre_table_tokenise(spark, sf_dir):
    """Fixed-column lines put together from orders, taken apart again by the text-table operator."""
    o = read(spark, sf_dir, "orders")
    part = lambda c, m: (F.col(c) % m).cast("string")
    k, c, one = "o_orderkey", "o_custkey", F.lit("1")
    line = F.concat_ws(" ", (F.col(k) % 90 + 1).cast("string"), F.lit(" TEAM"), part(c, 50), part(k, 42), one, one, one, part(k, 60), part(c, 60), one, one, one, part(c, 31), part(k, 37), part(c, 99))
    rows = table_rows(o.select(k, F.regexp_replace(line, r"TEAM (\d+)", "TEAM $1x").alias("line")), F.lit(20), F.lit(True))
    return rows.select(k, "pos", F.regexp_replace("team", "x$", "").alias("team"), "played", "goals_for", "goals_against", "points")


@query("""select doc_id, case when lower(lang) in ('en', 'fr') then true else false end as promoted, lower(lang) in ('de', 'fr') as relegated from documents""")
def legend_flags_by_code(spark, sf_dir):
    """A legend's codes looked up for a symbol, here the language."""
    legend = F.lit("(EN) Promoted; (DE) Relegated, (FR) Play-off winners, relegation (ES) Champions")
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", legend.alias("legend"))
    flags = legend_flags(F.col("legend"), F.array(F.upper("lang")))
    return docs.select("doc_id", F.coalesce(flags["promoted"], F.lit(False)).alias("promoted"), F.coalesce(flags["relegated"], F.lit(False)).alias("relegated"))


@query("""select l_orderkey, l_linenumber, case l_linenumber when 1 then 'pos' when 2 then 'team' when 3 then 'goalsFor' when 4 then 'notes' when 5 then 'points' when 6 then 'other text' else 'goalAverage' end as field from lineitem""")
def header_alias(spark, sf_dir):
    texts = F.array(*[F.lit(t) for t in ("No.", " Club ", "Goals  for", "Qualification or relegation", "Pts.", "Other  Text", "Ga v")])
    n = F.least("l_linenumber", F.lit(7))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", league.header_field(texts[n - 1]).alias("field"))


@query(f"""with m as ({MATCHES}), t as (select season, cast(row_number() over (partition by season order by tier desc) - 1 as int) as idx, tier = 1 as top, count(*) as n from m group by season, tier),
  first as (select season, coalesce(min(case when top then idx end), 0) as top_index from t group by season)
  select f.season, f.top_index, min(case when t.idx > f.top_index and t.n > 0 then t.idx end) as second_index from first f join t on t.season = f.season group by f.season, f.top_index""")
def major_tier_indexes(spark, sf_dir):
    tables = matches(spark, sf_dir).groupBy("season", "tier").agg(F.count("*").alias("n_rows"))
    index = F.row_number().over(Window.partitionBy("season").orderBy(F.desc("tier"))) - 1
    return major_tiers(tables.select("season", index.alias("table_no"), (F.col("tier") == 1).alias("is_top_flight"), "n_rows"), ["season"])


@query("""select p_partkey, concat(upper(p_name[1]), lower(p_name[2:])) as title, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug, trim(p_type) as trimmed from part""")
def text_forms(spark, sf_dir):
    name = F.col("p_name")
    return read(spark, sf_dir, "part").select("p_partkey", league.title_case(name).alias("title"), league.output_slug(name).alias("slug"), js_trim(F.col("p_type")).alias("trimmed"))


@query("""select o_orderkey, cast(o_orderkey % 1000 as double) as number, cast(o_custkey as bigint) as whole, try_cast(o_custkey % 7 || '.5' as double) as part, -cast(o_custkey % 9 as double) as minus from orders""")
def number_forms(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", js_number(F.concat(F.lit(" "), (k % 1000).cast("string"), F.lit(" "))).alias("number"), js_parse_int(F.concat(c.cast("string"), F.lit("px"))).alias("whole"),
        js_parse_float(F.concat((c % 7).cast("string"), F.lit(".5.7"))).alias("part"), league.cell_number(F.concat(F.lit("−"), (c % 9).cast("string"), F.lit("[")), True).alias("minus"),
    )


# Extraction and normalising, over pages and JSON that are put together from the league tables.

_CELLS = ("pos", "team", "played", "won", "draw", "lost", "goals_for", "goals_against", "points")
_NOTE = "case when pos = 1 then 'Promoted' when pos > size - 2 then 'Relegated to the next tier' end"


def _noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.count("*").over(Window.partitionBy("season", "tier"))
    return standings.league_table(matches(spark, sf_dir)).withColumn("size", size).withColumn("note", F.expr(_NOTE))


def _pages(noted: DataFrame, titles: str, wrap: str) -> DataFrame:
    """(season, html): a page a season, with a table a tier; titles: header cells, wrap: what stands before a table, by tier."""
    cells = F.concat(*[F.concat(F.lit("<td>"), F.col(c).cast("string"), F.lit("</td>")) for c in _CELLS], F.lit("<td>"), F.coalesce("note", F.lit("")), F.lit("</td>"))
    line = F.struct("pos", F.concat(F.lit("<tr>"), cells, F.lit("</tr>")).alias("line"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda r: r["line"]), "")
    head = F.concat(F.lit('<table class="wikitable"><tr>'), *[F.lit(f"<th>{t}</th>") for t in titles.split("|")], F.lit("</tr>"))
    tables = noted.groupBy("season", "tier").agg(F.concat(F.expr(wrap), head, lines, F.lit("</table>")).alias("html"))
    return tables.groupBy("season").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tier", "html"))), lambda r: r["html"]), "").alias("html"))


_TITLES = "Pos|Team|Pld|W|D|L|GF|GA|Pts|Notes"
_OUT = "cast(pos as double) as pos, team, cast(played as double) as played, cast(won as double) as won, cast(goals_for as double) as goals_for, cast(points as double) as points"


@query(f"""with {_SIDES} select season, case when tier = 1 then 'first' else 'second' end as division, cast(pos - 1 as int) as row_ord, {_OUT}, {_NOTE} as notes,
  pos > size - 2 and pos > 1 as was_relegated, tier = 2 and pos = 1 as was_promoted from ranked""")
def division_tables(spark, sf_dir):
    """Division pages made of the league tables, and parsed."""
    wrap = """concat('<div><span class="mw-headline" id="', if(tier = 1, 'First', 'Second'), '_Division">x</span></div>')"""
    rows = html.division_rows(_pages(_noted(spark, sf_dir), _TITLES, wrap), ["season"])
    return rows.select("season", "division", "row_ord", "pos", "team", "played", "won", "goals_for", "points", "notes", "was_relegated", "was_promoted")


@query(f"""with {_SIDES}, t as (select distinct season, tier from ranked), n as (select *, cast(row_number() over (partition by season order by tier) - 1 as int) as table_no from t)
  select r.season, n.table_no, case when r.tier = 1 then 'Premier League' else 'Second Division' end as title, r.tier = 1 as is_top_flight, {_OUT}, {_NOTE} as notes, r.tier = 2 and pos = 1 as was_promoted
  from ranked r join n on n.season = r.season and n.tier = r.tier""")
def overview_tables(spark, sf_dir):
    """Overview pages made of the league tables, and parsed."""
    wrap = """concat('<div class="mw-heading mw-heading3"><h3 id="t', tier, '">', if(tier = 1, 'Premier League', 'Second Division'), '</h3></div>')"""
    pages = _pages(_noted(spark, sf_dir), _TITLES, wrap)
    whole = pages.withColumn("html", F.concat(F.lit('<div class="mw-heading mw-heading2"><h2 id="League_tables">League tables</h2></div>'), "html"))
    rows = html.overview_rows(whole, ["season"])
    return rows.select("season", "table_no", "title", "is_top_flight", "pos", "team", "played", "won", "goals_for", "points", "notes", "was_promoted")


@query(f"""with {_SIDES} select season, tier, cast(pos as bigint) as pos, concat(upper(team[1]), lower(team[2:])) as team, cast(played as bigint) as played, cast(goals_for as bigint) as goals_for, cast(points as bigint) as points from ranked""")
def text_block_tables(spark, sf_dir):
    """Fixed-column pages made of the league tables, and parsed: all goals at home, none away."""
    noted = _noted(spark, sf_dir)
    figures = [F.col(c).cast("string") for c in ("played", "won", "draw", "lost", "goals_for", "goals_against")] + [F.lit("0")] * 5 + [F.col("points").cast("string")]
    line = F.concat_ws(" ", F.concat(F.lit(" "), F.col("pos").cast("string"), F.lit(".")), F.initcap("team"), *figures)
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda r: r["line"]), "\n")
    head = F.concat(F.lit("\nLeague - "), F.col("season").cast("string"), F.lit("\n\n P W D L F A W D L F A Pts\n"))
    blocks = noted.groupBy("season", "tier").agg(lines.alias("lines")).select(F.col("season").alias("page_id"), (F.col("tier") - 1).alias("block_no"), F.concat(head, "lines").alias("text"))
    rows = textpages.competitions(blocks)[1]
    return rows.select(F.col("page_id").alias("season"), (F.col("block_no") + 1).cast("int").alias("tier"), "pos", "team", "played", "goals_for", "points")


@query(f"""with {_SIDES} select cast(season as varchar) as season_key, concat('tier', tier) as tier_key, team, cast(pos as double) as pos, cast(goal_difference as double) as goal_difference,
  pos > size - 2 and pos > 1 as was_relegated, pos = 1 as was_promoted from ranked""")
def normalised_entries(spark, sf_dir):
    """JSON of seasons made of the league tables, numbers as text and flags left to the notes, read and normalised."""
    noted = _noted(spark, sf_dir)
    text = lambda c: F.concat(F.lit(" "), F.col(c).cast("string"))
    row = F.struct("pos", text("pos").alias("p"), F.concat(F.lit(" "), "team").alias("team"), text("goals_for").alias("goalsFor"), text("goals_against").alias("goalsAgainst"), F.lit(999).alias("goalDifference"), F.col("note").alias("notes"))
    rows = F.transform(F.array_sort(F.collect_list(row)), lambda r: F.struct(r["p"].alias("pos"), r["team"], r["goalsFor"], r["goalsAgainst"], r["goalDifference"], r["notes"]))
    tiers = noted.groupBy("season", "tier").agg(rows.alias("rows"))
    seasons = tiers.groupBy("season").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("tier"), F.col("tier").cast("string")), "rows"))).alias("s"))
    texts = seasons.select(F.lit(0).alias("source_rank"), F.to_json(F.struct(F.create_map(F.col("season").cast("string"), "s").alias("seasons"))).alias("value"))
    entries = normalise(raw_tiers(texts)).entries
    return entries.select("season_key", "tier_key", "team", "pos", "goal_difference", "was_relegated", "was_promoted")
