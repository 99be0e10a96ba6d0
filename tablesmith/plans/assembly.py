"""Registered queries of validation, season assembly, merging and page parsing, over JSON and pages made of the league tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.operators import html, lint, merge, seasons, standings, textpages
from tablesmith.operators.dataset import Dataset, normalise, raw_tiers
from tablesmith.plans.matches import matches
from tablesmith.plans.queries import _CELLS, _NOTE, _SIDES, _SOURCES, _TITLES, _noted, _pages, _sources, query
from tablesmith.sources import sinks

# JSON of seasons in which each rule of validation is broken somewhere, by the season's number.


def _sized(spark, sf_dir) -> DataFrame:
    return _noted(spark, sf_dir).drop("note")


def _gathered(rows: Column) -> Column:
    """A JSON array of struct<o, line> in order of o."""
    return F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda r: r["line"]), ","), F.lit("]"))


def _raw(tiers: DataFrame) -> DataFrame:
    """Raw tiers of tiers(season, tier_key, tier_ord, tier_json)."""
    return tiers.select(F.lit(0).alias("source_rank"), F.col("season").cast("string").alias("season_key"), F.col("season").alias("season_ord"), "tier_key", F.col("tier_ord").cast("int").alias("tier_ord"), "tier_json")


def _faulty(spark, sf_dir) -> Dataset:
    table = _sized(spark, sf_dir)
    line = F.to_json(F.struct(
        F.expr("if(season % 4 = 1 and pos = 2, 1, pos)").alias("pos"), "team", F.expr("played + if(pos = 3 and season % 3 = 0, 1, 0)").alias("played"), "won", F.col("draw").alias("drawn"), "lost",
        F.col("goals_for").alias("goalsFor"), F.col("goals_against").alias("goalsAgainst"), F.expr("goal_difference + if(pos = 4 and season % 6 = 0, 7, 0)").alias("goalDifference"), "points",
        F.expr("tier = 2 and pos = 1").alias("wasPromoted"), F.expr("tier = 1 and pos = size").alias("wasRelegated"),
    ))
    again = F.expr("""concat('{"pos":', size + 1, ',"team":"', upper(team), ' "}')""")
    own = table.select("season", "tier", "team", "pos", "size", F.col("pos").alias("o"), line.alias("line"))
    twice = table.filter("season % 7 = 0 and pos = 1").select("season", "tier", "team", F.lit(None).cast("int").alias("pos"), "size", (F.col("size") + 1).alias("o"), again.alias("line"))
    rows = own.unionByName(twice).groupBy("season", "tier").agg(_gathered(F.struct("o", "line")).alias("table"), F.max(F.when(F.col("pos") == 1, F.col("team"))).alias("best"), F.max(F.when(F.col("pos") == F.col("size"), F.col("team"))).alias("worst"))
    lists = """',"promoted":', if(tier = 1, '[]', if(season % 2 = 0, concat('["', best, '"]'), '["Nobody FC"]')), ',"relegated":', if(tier = 2, '[]', if(season % 4 < 2, concat('[" ', upper(worst), '"]'), '["Ghost United"]'))"""
    whole = F.expr(f"""concat('{{"season":', season + if(season % 5 = 0, 1, 0), ',"table":', table, {lists}, '}}')""")
    none = F.expr("season % 11 = 0 or season % 13 = 0 and tier = 2")
    tiers = rows.select("season", F.concat(F.lit("tier"), "tier").alias("tier_key"), F.col("tier").alias("tier_ord"), F.when(none, F.lit("[]")).otherwise(whole).alias("tier_json"))
    return normalise(_raw(tiers))


_FAULTS = f"""{_SIDES},
kept as (select * from ranked where season % 11 <> 0 and not (season % 13 = 0 and tier = 2)),
ends as (select season, tier, max(case when pos = 1 then team end) as best, max(case when pos = size then team end) as worst, max(size) as size from kept group by season, tier),
gone as (select distinct season, tier from ranked where season % 11 = 0 or season % 13 = 0 and tier = 2),
issues as (
  select season, null as tier, 'missing-season-data' as rule, 'No tier table/promoted/relegated data detected for this season' as message from gone where season not in (select season from kept) group by season
  union all select season, tier, 'empty-tier', 'Tier has no table rows or outcome lists' from gone where season in (select season from kept)
  union all select season, tier, 'season-mismatch', concat('Tier season (', season + 1, ') does not match key ', season) from ends where season % 5 = 0
  union all select season, tier, 'duplicate-teams', concat('Duplicate teams detected: ', best) from ends where season % 7 = 0
  union all select season, tier, 'duplicate-positions', 'Duplicate position values detected: 1' from ends where season % 4 = 1 and size > 1
  union all select season, tier, 'match-count-mismatch', concat('Played totals do not equal won+drawn+lost for: ', team) from kept where pos = 3 and season % 3 = 0
  union all select season, tier, 'goal-diff-mismatch', concat('Goal difference does not equal GF-GA for: ', team) from kept where pos = 4 and season % 6 = 0
  union all select season, tier, 'promoted-mismatch', concat('Promoted list missing flagged teams: ', best) from ends where tier = 2 and season % 2 = 1
  union all select season, tier, 'promoted-unknown', 'Promoted list includes teams not in table: Nobody FC' from ends where tier = 2 and season % 2 = 1
  union all select season, tier, 'relegated-mismatch', concat('Relegated list missing flagged teams: ', worst) from ends where tier = 1 and season % 4 >= 2
  union all select season, tier, 'relegated-unknown', 'Relegated list includes teams not in table: Ghost United' from ends where tier = 1 and season % 4 >= 2
)"""


@query(f"with {_FAULTS} select cast(season as varchar) as season_key, case when tier is not null then concat('tier', tier) end as tier_key, rule, message from issues")
def lint_issues(spark, sf_dir):
    """Every rule of validation, broken by the season's number."""
    return lint.lint(_faulty(spark, sf_dir), raw_differences=True).select("season_key", "tier_key", "rule", "message")


@query(f"with {_FAULTS} select rule, count(*) as n from issues group by rule")
def lint_totals(spark, sf_dir):
    return lint.totals(lint.lint(_faulty(spark, sf_dir), raw_differences=True))


@query(f"""with {_SIDES} select season, tier, team from ranked where pos = 3 and season % 3 = 0 and season % 11 <> 0 and not (season % 13 = 0 and tier = 2)""")
def stat_identity_check(spark, sf_dir):
    """Entries whose matches do not add up, as the rule for them names them."""
    issues = lint.lint(_faulty(spark, sf_dir)).filter("rule = 'match-count-mismatch'")
    named = F.explode(F.split(F.regexp_extract("message", ": (.*)$", 1), ", "))
    return issues.select(F.col("season_key").cast("int").alias("season"), F.substring("tier_key", 5, 9).cast("int").alias("tier"), named.alias("team"))


def _faulty_overview(spark, sf_dir) -> DataFrame:
    table = _sized(spark, sf_dir)
    pos = F.expr("case when season % 8 = 1 and pos = 3 then 'null' when season % 8 = 2 and pos = 4 then '4.5' when season % 8 = 3 and pos = 5 then '1' else cast(pos as string) end")
    line = F.concat(F.lit('{"pos":'), pos, F.expr("""concat(',"team":"', case when season % 8 = 0 and pos = 2 then ' ' when season % 8 = 4 and pos = 6 then upper(best) else team end, '"}')"""))
    best = table.filter("pos = 1").select("season", "tier", F.col("team").alias("best"))
    rows = table.join(best, ["season", "tier"]).groupBy("season", "tier").agg(_gathered(F.struct(F.col("pos").alias("o"), line.alias("line"))).alias("table"))
    counted = rows.join(rows.groupBy("season").agg(F.count("*").alias("n"), F.min("tier").alias("first_tier")), "season")
    held = "case when tier = first_tier and season % 7 = 0 then '' when tier = first_tier and season % 11 = 0 then ',\"table\":[]' else concat(',\"table\":', table) end"
    whole = F.expr(f"""concat('{{"title":"League ', tier, '"', {held}, ',"seasonMetadata":{{"tableIndex":', tier - first_tier + if(season % 6 = 0, 1, 0), ',"tableCount":', n + if(season % 9 = 0, 2, 0), '}}}}')""")
    tiers = counted.select("season", F.concat(F.lit("tier"), F.expr("tier + if(season % 4 = 0 and tier = 2, 1, 0)")).alias("tier_key"), F.col("tier").alias("tier_ord"), whole.alias("tier_json"))
    infos = counted.filter("tier = first_tier and season % 5 <> 0").select("season", F.lit("seasonInfo").alias("tier_key"), F.lit(0).alias("tier_ord"), F.expr("""concat('{"tableCount":', n + if(season % 3 = 0, 1, 0), '}')""").alias("tier_json"))
    return _raw(tiers.unionByName(infos))


@query(f"""with {_SIDES},
shape as (select season, tier, max(size) as size, max(case when pos = 1 then team end) as best from ranked group by season, tier),
counts as (select season, count(*) as n, min(tier) as first_tier, max(tier) as last_tier from shape group by season),
t as (select s.*, n, first_tier, cast(tier - first_tier as int) as idx, concat('tier ', tier + case when season % 4 = 0 and tier = 2 then 1 else 0 end, ' (League ', tier, ')') as label,
  tier = first_tier and season % 7 = 0 as absent, tier = first_tier and season % 7 <> 0 and season % 11 = 0 as bare from shape s join counts c using (season)),
r as (select t.label, t.best, ranked.* from ranked join t using (season, tier) where not absent and not bare),
found as (
  select season, 'error' as severity, 'Missing seasonInfo block' as message from counts where season % 5 = 0
  union all select season, 'warning', concat('Table count mismatch: seasonInfo.tableCount=', n + 1, ', actual=', n) from counts where season % 5 <> 0 and season % 3 = 0
  union all select season, 'warning', concat('Tier keys are non-sequential: found [', case when n = 2 then 'tier1, ' else '' end, case when last_tier = 1 then 'tier1' when season % 4 = 0 then 'tier3' else 'tier2' end, ']') from counts where last_tier = 2 and (season % 4 = 0 or n = 1)
  union all select season, 'error', concat(label, ': table is missing or not an array') from t where absent
  union all select season, 'warning', concat(label, ': table is empty') from t where bare
  union all select season, 'warning', concat(label, ': seasonMetadata.tableIndex=', idx + 1, ' but expected ', idx) from t where not absent and season % 6 = 0
  union all select season, 'warning', concat(label, ': seasonMetadata.tableCount=', n + 2, ' but season has ', n, ' tiers') from t where not absent and season % 9 = 0
  union all select season, 'error', concat(label, ' row 2: missing team name') from r where season % 8 = 0 and pos = 2
  union all select season, 'error', concat(label, ' row 3: missing or invalid pos value') from r where season % 8 = 1 and pos = 3
  union all select season, 'warning', concat(label, ' row 4: pos is not an integer (4.5)') from r where season % 8 = 2 and pos = 4
  union all select season, 'error', concat(label, ': duplicate position 1 (rows 1 and 5)') from r where season % 8 = 3 and pos = 5
  union all select season, 'warning', concat(label, ': duplicate team name "', upper(best), '" (rows 1 and 6)') from r where season % 8 = 4 and pos = 6
)
select cast(season as varchar) as season_key, severity, message from found""")
def overview_lint_issues(spark, sf_dir):
    """Every check of overview datasets, failed by the season's number."""
    return lint.lint_overview(_faulty_overview(spark, sf_dir)).select("season_key", "severity", "message")


# Merging of datasets, publishing, and reading back.


def _ranked(spark, sf_dir) -> Dataset:
    """The sources of the merging queries as one dataset: tiers with n rows are arrays of n teams."""
    entries = F.transform(F.sequence(F.lit(1), F.col("n")), lambda k: F.concat(F.lit('{"team":"t'), k.cast("string"), F.lit('","goalsFor":'), k.cast("string"), F.lit("}")))
    text = F.when(F.col("n") > 0, F.concat(F.lit("["), F.array_join(entries, ","), F.lit("]"))).otherwise(F.lit("[]"))
    raw = _sources(spark, sf_dir).select("source_rank", "season_key", F.col("season_key").cast("int").alias("season_ord"), "tier_key", F.substring("tier_key", 5, 9).cast("int").alias("tier_ord"), text.alias("tier_json"))
    return normalise(raw)


def _datasets(spark, sf_dir) -> list[Dataset]:
    """The sources as datasets of their own."""
    whole = _ranked(spark, sf_dir)
    return [whole.where(F.col("source_rank") == k) for k in range(3)]


_MERGED = f"""{_SOURCES}, placed as (select *, row_number() over (partition by season_key, tier_key order by (n > 0) desc, source_rank) as place from sources),
judged as (select season_key, bool_or(n > 0) as data, cast(season_key as int) between 1915 and 1918 or cast(season_key as int) between 1940 and 1945 as war from placed where place = 1 group by season_key)"""


@query(f"""with {_MERGED} select p.season_key, p.tier_key, p.source_rank, cast(n as int) as n_rows, cast(n * (n + 1) / 2 as double) as goals from placed p join judged using (season_key) where place = 1 and data and not war""")
def combined_tiers(spark, sf_dir):
    """Three datasets merged: which tiers stay, of which source, and their rows."""
    data, _ = merge.combine_ranked(_ranked(spark, sf_dir), 3)
    goals = data.entries.groupBy("source_rank", "season_key", "tier_key").agg(F.sum("goal_difference").alias("goals"))
    held = data.tiers.join(goals, ["source_rank", "season_key", "tier_key"], "left")
    return held.select("season_key", "tier_key", "source_rank", "n_rows", F.coalesce("goals", F.lit(0.0)).alias("goals"))


@query(f"""with {_MERGED} select count(*) filter (where not war and data) as merged_seasons, count(*) filter (where not war and not data) as excluded, count(*) filter (where war) as removed_war_seasons,
  (select count(*) from (select distinct source_rank, season_key from sources)) as input_seasons, array_to_string(list(season_key order by season_key) filter (where not war and not data), ',') as missing from judged""")
def merge_stats(spark, sf_dir):
    _, figures = merge.combine_ranked(_ranked(spark, sf_dir), 3)
    missing = F.array_join(F.transform("missing_seasons", lambda x: x.cast("string")), ",")
    return figures.select("merged_seasons", "excluded", "removed_war_seasons", "input_seasons", F.when(F.size("missing_seasons") > 0, missing).alias("missing"))


@query(f"""with {_MERGED} select season_key, max(source_rank) as source_rank, sum(n) as n_rows from sources s where source_rank = (select max(source_rank) from sources o where o.season_key = s.season_key) group by season_key""")
def overwritten_seasons(spark, sf_dir):
    """Three datasets merged so that a season comes whole from the last one that has it."""
    data = merge.overwrite(_datasets(spark, sf_dir))
    return data.tiers.groupBy("season_key").agg(F.max("source_rank").alias("source_rank"), F.sum("n_rows").alias("n_rows"))


@query(f"""with {_SIDES} select cast(season as varchar) as season_key, concat('tier', tier) as tier_key, cast(count(*) as bigint) as n_rows, cast(sum(goals_for) as double) as goals, cast(sum(pos * points) as double) as checksum from ranked group by season, tier""")
def json_roundtrip_counts(spark, sf_dir):
    """A dataset published as JSON, season by season, and read back."""
    cells = {"pos": "pos", "team": "team", "goalsFor": "goals_for", "goalsAgainst": "goals_against", "points": "points"}
    line = F.to_json(F.struct(*[F.col(c).alias(k) for k, c in cells.items()]))
    tiers = _sized(spark, sf_dir).groupBy("season", "tier").agg(_gathered(F.struct(F.col("pos").alias("o"), line.alias("line"))).alias("table"))
    whole = F.expr("""concat('{"season":', season, ',"title":"a \\\\"quoted\\\\" title","table":', table, '}')""")
    data = normalise(_raw(tiers.select("season", F.concat(F.lit("tier"), "tier").alias("tier_key"), F.col("tier").alias("tier_ord"), F.when(F.col("tier") == 1, whole).otherwise(F.col("table")).alias("tier_json"))))
    published = sinks.seasons_json(data).select(F.lit(0).alias("source_rank"), F.concat(F.lit('{"seasons":{"'), "season_key", F.lit('":'), "json", F.lit("}}")).alias("value"))
    read = normalise(raw_tiers(published)).entries
    return read.groupBy("season_key", "tier_key").agg(F.count("*").alias("n_rows"), F.sum("goals_for").alias("goals"), F.sum(F.col("pos") * F.col("points")).alias("checksum"))


@query(f"""with {_SIDES} select cast(season as varchar) as season_key, concat('tier', tier) as tier_key, team, {_NOTE} as notes from ranked where season % 2 = 0 and {_NOTE} is not null""")
def dataset_notes(spark, sf_dir):
    """Notes of the tiers that are bare tables, which those of even seasons are."""
    line = F.to_json(F.struct("team", F.col("note").alias("notes")))
    tiers = _noted(spark, sf_dir).groupBy("season", "tier").agg(_gathered(F.struct(F.col("pos").alias("o"), line.alias("line"))).alias("table"))
    text = F.when(F.col("season") % 2 == 0, F.col("table")).otherwise(F.concat(F.lit('{"table":'), "table", F.lit("}")))
    return sinks.notes(normalise(_raw(tiers.select("season", F.concat(F.lit("tier"), "tier").alias("tier_key"), F.col("tier").alias("tier_ord"), text.alias("tier_json")))))


@query(f"""with {_SIDES}, s as (select distinct tier, season from ranked), d as (select tier, season, (dense_rank() over (partition by tier order by season) - 1) // 4 as c from s),
  l as (select tier, season, concat(min(season) over (partition by tier, c), '-', max(season) over (partition by tier, c)) as chunk from d)
  select r.tier, chunk, count(*) as n, count(distinct season) as seasons from ranked r join l using (tier, season) group by r.tier, chunk""")
def split_by_tier_counts(spark, sf_dir):
    """Rows dealt to files of a tier and a chunk of seasons."""
    rows = sinks.with_chunks(_sized(spark, sf_dir).withColumn("season", F.concat("season", F.lit(" "))).withColumnRenamed("season", "Season"), 4)
    return rows.groupBy("tier", "chunk").agg(F.count("*").alias("n"), F.countDistinct("Season").alias("seasons"))


# Seasons put together from parsed pages.

_JOINED = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), ",")
_ABOUT = ["season_key", "tier_key", "tier_ord", "n_rows", "promoted", "relegated"]


def _about(data: Dataset, *more: str) -> DataFrame:
    """A row a block: its place, rows, lists, and some of its other fields."""
    lists = [_JOINED(side).alias(side) for side in ("promoted", "relegated")]
    return data.tiers.select("season_key", "tier_key", "tier_ord", "n_rows", *lists, *[F.col("extra")[m].alias(m) for m in more])


_MOVED = f"""{_SIDES}, flagged as (select *, tier = 2 and pos = 1 as up, pos > size - 2 and pos > 1 as down from ranked),
lists as (select season, tier, count(*) as n, coalesce(string_agg(team, ',' order by pos) filter (where up), '') as up, coalesce(string_agg(team, ',' order by pos) filter (where down), '') as down from flagged group by season, tier),
two as (select season, coalesce(max(case when tier = 1 then n end), 0) as n1, coalesce(max(case when tier = 2 then n end), 0) as n2, coalesce(max(case when tier = 1 then down end), '') as down1,
  coalesce(max(case when tier = 2 then up end), '') as up2, coalesce(max(case when tier = 2 then down end), '') as down2, bool_or(tier = 1) as has1, bool_or(tier = 2) as has2 from lists group by season)"""


@query(f"""with {_MOVED} select cast(season as varchar) as season_key, tier_key, tier_ord, n_rows, promoted, relegated, concat('page_', season) as "seasonSlug" from (
  select season, 'seasonInfo' as tier_key, 0 as tier_ord, 0 as n_rows, up2 as promoted, down1 as relegated from two
  union all select season, 'tier1', 1, cast(n1 as int), '', down1 from two union all select season, 'tier2', 2, cast(n2 as int), up2, down2 from two where has2)""")
def promotion_season_tiers(spark, sf_dir):
    """Division pages parsed and put together as seasons."""
    wrap = """concat('<div><span class="mw-headline" id="', if(tier = 1, 'First', 'Second'), '_Division">x</span></div>')"""
    made = _pages(_noted(spark, sf_dir), _TITLES, wrap)
    data = seasons.promotion_seasons(made.select("season", F.concat(F.lit("page_"), "season").alias("slug")), html.division_rows(made, ["season"]))
    return _about(data, "seasonSlug")


@query(f"""with {_MOVED}, placed as (select *, row_number() over (partition by season order by tier) as k, count(*) over (partition by season) as size from lists) select cast(season as varchar) as season_key, tier_key, tier_ord, n_rows, promoted, relegated, title, "tableCount" from (
  select season, 'seasonInfo' as tier_key, 0 as tier_ord, 0 as n_rows, case when has1 then up2 else '' end as promoted, case when has1 then down1 else down2 end as relegated, null as title,
    cast(cast(has1 as int) + cast(has2 as int) as varchar) as "tableCount" from two
  union all select season, concat('tier', k), cast(k as int), cast(n as int), up, down, case when tier = 1 then 'Premier League' else 'Second Division' end, null from placed)""")
def overview_season_tiers(spark, sf_dir):
    """Overview pages, whose league section is told by its heading's words, parsed and put together as seasons; codes behind teams are explained by a legend."""
    noted = _sized(spark, sf_dir).withColumn("note", F.lit(None).cast("string"))
    code = F.expr("concat(if(tier = 2 and pos = 1, ' (C, P)', ''), if(pos > size - 2 and pos > 1, ' (R)', ''))")
    wrap = """concat('<div class="mw-heading mw-heading3"><h3 id="t', tier, '">', if(tier = 1, 'Premier League', 'Second Division'), '</h3></div>')"""
    legend = '<div class="sports-table-notes">(C) Champions; (P) Promoted; (R) Relegated</div>'
    pages = _pages(noted.withColumn("team", F.concat("team", code)), _TITLES, wrap).withColumn("html", F.replace("html", F.lit("</table>"), F.lit("</table>" + legend)))
    heads = ['<div class="mw-heading mw-heading2"><h2 id="w">Women\'s league tables</h2></div><p>', '<div class="mw-heading mw-heading2"><h2 id="m">Men\'s football league table</h2></div>', '<div class="mw-heading mw-heading2"><h2 id="c">Cups</h2></div>']
    whole = pages.withColumn("html", F.concat(F.lit(heads[1]), "html", F.lit(heads[2]), "html"))
    rows = html.overview_rows(whole, ["season"]).withColumn("season_key", F.col("season").cast("string")).withColumn("team", F.regexp_replace("team", r" \(.*$", ""))
    tables = rows.select("season_key", "table_no", "title", "heading_id", "table_index", "is_top_flight").distinct()
    data = seasons.overview_seasons(whole.select("season", F.col("season").cast("string").alias("season_key"), F.concat(F.lit("page_"), "season").alias("slug")), tables, rows)
    return _about(data, "title", "tableCount")


@query(f"""with {_SIDES}, t as (select season, tier, row_number() over (partition by season order by tier) as k, count(*) as n, string_agg(concat(upper(team[1]), lower(team[2:])), ',' order by pos) filter (where tier = 1 and pos = size) as down from ranked group by season, tier)
  select cast(season as varchar) as season_key, concat('tier', k) as tier_key, cast(k - 1 as int) as tier_ord, cast(n as int) as n_rows, '' as promoted, case when k = 1 then coalesce(down, '') else '' end as relegated from t""")
def text_season_tiers(spark, sf_dir):
    """Fixed-column pages, whose last team is in capitals, parsed and put together as seasons."""
    noted = _sized(spark, sf_dir)
    figures = [F.col(c).cast("string") for c in ("played", "won", "draw", "lost", "goals_for", "goals_against")] + [F.lit("0")] * 5 + [F.col("points").cast("string")]
    name = F.expr("if(tier = 1 and pos = size, upper(team), initcap(team))")
    line = F.concat_ws(" ", F.concat(F.lit(" "), F.col("pos").cast("string"), F.lit(".")), name, *figures, F.lit("*"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda r: r["line"]), "\n")
    head = F.concat(F.lit("\nLeague - "), F.col("season").cast("string"), F.lit("\n\n P W D L F A W D L F A Pts\n"))
    page = F.concat(F.lit("<pre>"), head, lines, F.lit("\n* Founder member\n</pre>"))
    tables = noted.groupBy("season", "tier").agg(page.alias("page"))
    pages = tables.groupBy(F.col("season").alias("page_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tier", "page"))), lambda r: r["page"]), "<p>").alias("html"))
    heads, rows = textpages.competitions(html.text_blocks(pages, ["page_id"]))
    own = textpages.page_seasons(heads).select("page_id", F.regexp_extract(F.array_join("seasons", " "), r"(\d{4})", 1).try_cast("int").alias("season"), "season_slug")
    return _about(seasons.text_seasons(heads, rows, own))


@query(f"""with {_SIDES}, r as (select *, (pos - 1) % 3 as k from ranked) select season, case when tier = 1 then 'first' else 'second' end as division, cast(pos - 1 as int) as row_ord, team,
  concat('Relegated ', (pos - 1) // 3) as notes, true as was_relegated from r where k <> 2
  union all select season, case when tier = 1 then 'first' else 'second' end, cast(pos - 1 as int), team, null, false from r where k = 2""")
def rowspan_pages(spark, sf_dir):
    """Division pages in which each third row's note spans it and the next, parsed."""
    noted = _sized(spark, sf_dir)
    cells = F.concat(*[F.concat(F.lit("<td>"), F.col(c).cast("string"), F.lit("[1]</td>") if c == "team" else F.lit("</td>")) for c in _CELLS])
    note = F.expr("case (pos - 1) % 3 when 0 then concat('<td rowspan=\"2\">Relegated ', (pos - 1) div 3, '<sup class=\"reference\">[2]</sup></td>') when 1 then '' else '<td></td>' end")
    line = F.struct("pos", F.concat(F.lit("<tr>"), cells, note, F.lit("</tr>")).alias("line"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda r: r["line"]), "")
    head = F.concat(F.lit('<div class="wikitable"><table><tr>'), *[F.lit(f"<th>{t}</th>") for t in _TITLES.split("|")], F.lit("</tr>"))
    wrap = F.expr("""concat('<div><h2 id="', if(tier = 1, 'First', 'Second'), '_Division">x</h2></div>')""")
    tables = noted.groupBy("season", "tier").agg(F.concat(wrap, head, lines, F.lit("</table></div>")).alias("html"))
    pages = tables.groupBy("season").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tier", "html"))), lambda r: r["html"]), "").alias("html"))
    return html.division_rows(pages, ["season"]).select("season", "division", "row_ord", "team", "notes", "was_relegated")


@query(f"""with {_SIDES} select season, array_to_string(list(distinct team order by team) filter (where tier = 1 and pos > size - 2 and pos > 1), ',') as relegated, array_to_string(list(distinct team order by team) filter (where pos = 1), ',') as new_clubs from ranked group by season""")
def infobox_facts(spark, sf_dir):
    """Infoboxes made of the league tables, parsed."""
    links = lambda when: F.array_join(F.transform(F.array_sort(F.collect_set(F.when(F.expr(when), F.col("team")))), lambda t: F.concat(F.lit("<a>"), t, F.lit("</a>"))), ", ")
    made = _sized(spark, sf_dir).groupBy("season").agg(links("tier = 1 and pos > size - 2 and pos > 1").alias("down"), links("pos = 1").alias("new"))
    box = '<table class="infobox"><caption class="infobox-title"><a>The Football League</a></caption><tr><th>Relegated</th><td>'
    none = F.when(F.col("down") == "", F.lit("None")).otherwise(F.col("down"))
    page = F.concat(F.lit(box), none, F.lit("</td></tr><tr><th>New Clubs in League</th><td>"), "new", F.lit("</td></tr></table>"))
    facts = html.infoboxes(made.select(F.col("season").alias("page"), page.alias("html")), ["page"])
    joined = lambda c: F.when(F.size(c) > 0, F.array_join(c, ","))
    return facts.select(F.col("page").alias("season"), joined("relegated").alias("relegated"), joined("new_clubs").alias("new_clubs"))


@query(f"""with {_SIDES}, have as (select distinct season from ranked where tier = 1) select cast(y as int) as season from range(1888, 2025) t(y) where y not in (select season from have) and not (y between 1915 and 1919 or y between 1940 and 1946)""")
def seasons_left_to_fetch(spark, sf_dir):
    """Seasons that an update without war years still has to fetch, told from a dataset."""
    table = standings.league_table(matches(spark, sf_dir)).filter("tier = 1")
    tiers = table.groupBy("season", "tier").agg(_gathered(F.struct(F.col("pos").alias("o"), F.to_json(F.struct("team")).alias("line"))).alias("tier_json"))
    have = normalise(_raw(tiers.select("season", F.lit("tier1").alias("tier_key"), F.col("tier").alias("tier_ord"), "tier_json")))
    years = spark.range(1888, 2025).select(F.col("id").cast("int").alias("season"))
    return seasons.seasons_to_fetch(years, have, update_only=True, skip_war=True)
