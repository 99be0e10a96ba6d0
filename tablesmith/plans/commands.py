"""Registered queries of page dialects, fetching, files and the command line, over the league tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith import cli
from tablesmith.functions import league
from tablesmith.operators import html, merge, standings, textpages
from tablesmith.operators.dataset import Dataset, normalise, replace
from tablesmith.plans.assembly import _MOVED, _about, _raw, _sized
from tablesmith.plans.matches import SQL as MATCHES
from tablesmith.plans.matches import matches
from tablesmith.plans.queries import _CELLS, _SIDES, _TITLES, _noted, _pages, query, read
from tablesmith.plans.storage import _COUNTED, _counts, _dataset
from tablesmith.sources import datasets, page_source, pages, sinks
from tablesmith.sources.matches import as_matches, read_csv
from tablesmith.sources.shared import shared_folder


def _joined(rows: Column, by: str, between: str = "") -> Column:
    """Texts of a group in order of a column."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(by).alias("o"), rows.alias("line")))), lambda r: r["line"]), between)


@query(f"""with {_SIDES} select season, case when tier = 1 then 'first' else 'second' end as division, cast(row_number() over (partition by season, tier order by pos) - 1 as int) as row_ord,
  concat(team, case when pos = 1 then ' (C, P)' when pos = size then ' R' when pos = 2 then ' (O or X)' else '' end) as team, tier = 2 and pos <= 2 as was_promoted, pos = size and pos > 2 as was_relegated
  from ranked where pos <> 3""")
def legend_pages(spark, sf_dir):
    """Division pages whose team cells have codes, several at a time, that a legend below the table explains."""
    code = F.expr("case when pos = 1 then ' <b>(C, P)</b>' when pos = size then ' <i>R</i>' when pos = 2 then ' (O or X)' else '' end")
    cells = F.concat(*[F.concat(F.lit("<td>"), F.concat("team", code) if c == "team" else F.when((F.col("pos") == 3) & F.lit(c == "pos"), F.lit("")).otherwise(F.col(c).cast("string")), F.lit("</td>")) for c in _CELLS])
    titles = _TITLES.removesuffix("|Notes").split("|")
    again = F.when(F.col("pos") == 2, F.lit("<tr><td>Pos</td><td>Team</td><td>Pld</td></tr>")).otherwise(F.lit(""))
    lines = _joined(F.concat(again, F.lit("<tr>"), cells, F.lit("</tr>")), "pos")
    head = F.concat(F.lit('<table class="wikitable"><tr>'), *[F.lit(f"<th>{t}</th>") for t in titles], F.lit("</tr>"))
    legend = F.lit('</table><p>x</p><div class="sports-table-Legend">(C) Champions; (P, O) Promoted to the\n first; (X) Play-off winners; (R) Relegated or demoted</div>')
    wrap = F.expr("""concat('<div><span class="mw-headline" id="', if(tier = 1, 'First', 'Second'), '_Division">x</span></div>')""")
    tables = _sized(spark, sf_dir).groupBy("season", "tier").agg(F.concat(wrap, head, lines, legend).alias("html"))
    made = tables.groupBy("season").agg(_joined(F.col("html"), "tier").alias("html"))
    return html.division_rows(made, ["season"]).select("season", "division", "row_ord", "team", "was_promoted", "was_relegated")


@query(f"""with {_SIDES} select season, tier, cast(pos as bigint) as pos, case when pos = 1 then 'Champions First time in the League' when pos = size then 'Re-elected after reprievd from re-election' end as notes,
  pos = size and pos > 1 as was_re_elected, pos = size and pos > 1 as was_reprieved, pos = 1 as is_expansion_team from ranked""")
def marker_notes(spark, sf_dir):
    """Fixed-column pages whose lines have markers, which notes below the table explain."""
    figures = [F.col(c).cast("string") for c in ("played", "won", "draw", "lost", "goals_for", "goals_against")] + [F.lit("0")] * 5 + [F.col("points").cast("string")]
    marker = F.expr("case when pos = 1 then ' + **' when pos = size then ' *' else '' end")
    line = F.concat(F.concat_ws(" ", F.concat(F.lit(" "), F.col("pos").cast("string"), F.lit(".")), F.initcap("team"), *figures), marker)
    head = F.concat(F.lit("\nLeague - "), F.col("season").cast("string"), F.lit("\n\n P W D L F A W D L F A Pts\n"))
    notes = F.lit("\n+ Champions\n* Re-elected after reprievd from re-election\n** First time in the League\n")
    blocks = _sized(spark, sf_dir).groupBy("season", "tier").agg(F.concat(head, _joined(line, "pos", "\n"), notes).alias("text")).select(F.col("season").alias("page_id"), (F.col("tier") - 1).alias("block_no"), "text")
    rows = textpages.competitions(blocks)[1]
    return rows.select(F.col("page_id").alias("season"), (F.col("block_no") + 1).cast("int").alias("tier"), "pos", "notes", "was_re_elected", "was_reprieved", "is_expansion_team")


def _served(url: str) -> tuple[bytes, str]:
    """A page that tells its address, in a legacy encoding; seasons that begin with a multiple of seven are down."""
    if int(url.rsplit("/", 1)[1][:4]) % 7 == 0:
        raise OSError("down")
    return f"<p>“{url}” é".encode("cp1252"), "text/html; Charset=Windows-1252"


@query(f"""with m as ({MATCHES}), y as (select distinct season, concat(season, '-', lpad(cast((season + 1) % 100 as varchar), 2, '0')) as season_slug from m),
  u as (select *, concat('https://pages.example/', season_slug, '/', season + 1) as url from y)
  select season, season_slug, url, case when (season + 1) % 7 <> 0 then concat('<p>“', url, '” é') end as html, case when (season + 1) % 7 = 0 then 'down' end as error from u""")
def fetched_pages(spark, sf_dir):
    """Pages of the seasons that there are matches of, fetched by a fetcher that needs no network: decoded, failures as rows."""
    years = matches(spark, sf_dir).select("season").distinct()
    wanted = pages.season_urls(years, "https://pages.example/{seasonSlug}/{endYear}")
    fetcher = pages.first_of(pages.elsewhere(_served, "https://other.example/", "https://pages.example/"), _served)
    return pages.fetch(wanted, fetcher, 0, tasks=4)


@query(f"""with {_MOVED} select cast(season as varchar) as season_key, tier_key, n_rows, promoted, relegated, slug as "seasonSlug" from (
  select season, 'seasonInfo' as tier_key, 0 as n_rows, up2 as promoted, down1 as relegated from two
  union all select season, 'tier1', cast(n1 as int), '', down1 from two union all select season, 'tier2', cast(n2 as int), up2, down2 from two where has2)
  join (select distinct season, concat(season, '-', case when (season + 1) % 100 = 0 then cast(season + 1 as varchar) else lpad(cast((season + 1) % 100 as varchar), 2, '0') end, '_Football_League') as slug from two) using (season)""")
def built_seasons(spark, sf_dir):
    """The command line's build: pages of a table to a store, from there to a JSON file, and that file read."""
    wrap = """concat('<div><span class="mw-headline" id="', if(tier = 1, 'First', 'Second'), '_Division">x</span></div>')"""
    made = _pages(_noted(spark, sf_dir), _TITLES, wrap)
    folder = shared_folder(spark, "built")
    pages.promotion_pages(made.select("season")).join(made, "season").select("season", "url", "html").write.parquet(f"{folder}/pages")
    kept = spark.read.parquet(f"{folder}/pages")
    first, last = kept.agg(F.min("season"), F.max("season")).first()
    cli.main(["build", "-s", str(first), "-e", str(last), "--pages", f"{folder}/pages", "-o", f"{folder}/seasons.json"], spark)
    have = datasets.load(spark, f"{folder}/seasons.json")
    own = kept.select(F.col("season").cast("string").alias("season_key"))
    return _about(Dataset(have.tiers.join(own, "season_key", "left_semi"), have.entries), "seasonSlug").drop("tier_ord")


@query(f"with {_SIDES} select season, tier, team, cast(played as bigint) as played, cast(won as bigint) as won, cast(points as bigint) as points, cast(goal_difference as bigint) as goal_difference from ranked")
def csv_tables(spark, sf_dir):
    """Matches saved as CSV by tier and chunk of seasons, read back from all files, and counted."""
    folder = shared_folder(spark, "matches")
    rows = matches(spark, sf_dir).select(F.concat(F.col("season").cast("string"), F.lit("/x")).alias("Season"), "tier", "home", "visitor", "hgoal", "vgoal", "result", F.col("match_ord").alias("o"))
    sinks.save_chunks(rows, folder, 10, ("o",), rows_a_file=5000)
    table = standings.league_table(as_matches(read_csv(spark, folder)))
    return table.select("season", "tier", "team", "played", "won", "points", "goal_difference")


@query(f"""with m as ({MATCHES}), s as (select distinct season from m) select cast(season as varchar) as season_key, case when season % 2 = 0 then 'first' else 'second' end as note, concat('up', season) as promoted from s
  where not (season between 1915 and 1918 or season between 1940 and 1945)""")
def merged_season_info(spark, sf_dir):
    """Two datasets merged of which both have season information: the first one's stays."""
    years = matches(spark, sf_dir).select("season").distinct()

    def about(some: DataFrame, note: str) -> Dataset:
        text = F.concat(F.lit('{"promoted":["up'), "season", F.lit(f'"],"note":"{note}","table":[]}}'))
        return normalise(_raw(some.select("season", F.lit("seasonInfo").alias("tier_key"), F.lit(0).alias("tier_ord"), text.alias("tier_json"))))

    data, _ = merge.combine([about(years.filter("season % 2 = 0"), "first"), about(years, "second")])
    return data.tiers.select("season_key", F.col("extra")["note"].alias("note"), F.array_join("promoted", ",").alias("promoted"))


@query(f"with {_SIDES} select {_COUNTED.replace('sum(pos * points)', 'sum(pos * if(season % 2 = 0 and tier = 1, 1, points))')} from ranked group by season, tier")
def replaced_tiers(spark, sf_dir):
    """A dataset of which another one replaces some tiers and leaves the seasons' others."""
    rows = _sized(spark, sf_dir)
    new = rows.filter("season % 2 = 0 and tier = 1").withColumn("points", F.lit(1).cast("long"))
    return _counts(replace(_dataset(rows), _dataset(new)))


@query(r"""with d as (select doc_id, source, case doc_id % 4 when 0 then 'Reprived from re-election' when 1 then 'reprieved from re-election' when 2 then 'repriev' end as note,
    case doc_id % 5 when 0 then ' Yes ' when 1 then 'TRUE' when 2 then '1' when 3 then 'no' end as flag, concat('tier', doc_id % 9) as tier from documents)
  select doc_id, coalesce(note = 'Reprived from re-election', false) as reprieved, coalesce(note = 'reprieved from re-election', false) as reprieved_right, doc_id % 5 < 3 as flag,
    lower(trim(source)) as name, concat('tier ', doc_id % 9) as tier, case when doc_id % 3 = 0 then 'utf-8' when doc_id % 3 = 1 then 'iso-8859-1' end as encoding,
    cast(case when doc_id % 2 = 0 then 1900 + doc_id % 100 end as int) as year from d""")
def text_conventions(spark, sf_dir):
    """Misspelt notes, truthy words, names, tiers, encodings and labels as the data's conventions read them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    k = F.col("doc_id")
    pick = lambda n, *texts: F.element_at(F.array(*[F.lit(t) for t in texts], *[F.lit(None).cast("string")] * (n - len(texts))), (k % n + 1).cast("int"))
    note, flag = pick(4, "Reprived from re-election", "reprieved from re-election", "repriev"), pick(5, " Yes ", "TRUE", "1", "no")
    kind = pick(3, "text/html; charset=UTF-8", "text/html;CHARSET= ISO-8859-1 ; x")
    labels = F.when(k % 2 == 0, F.array(F.lit("no"), F.concat((1900 + k % 100).cast("string"), F.lit("/x"))))
    return docs.select(
        "doc_id", league.noted_reprieved(note).alias("reprieved"), league.noted_reprieved(note, False).alias("reprieved_right"), league.truthy(flag).alias("flag"), league.normal_name(F.col("source")).alias("name"),
        league.describe_tier(F.concat(F.lit("tier"), (k % 9).cast("string"))).alias("tier"), league.encoding_of(kind).alias("encoding"), league.labels_year(labels).alias("year"),
    )


@query("""select regexp_extract(url, '^[a-z]+://([^/]+)', 1) as slug, cast(sum(1 + length(html) - length(replace(html, chr(10), ''))) as bigint) as n_lines, cast(sum(length(replace(html, chr(10), ''))) as bigint) as n_chars
  from pages where html is not null group by slug""")
def saved_pages(spark, sf_dir):
    """Raw pages saved in a folder for each host, and the files' lines counted."""
    folder = shared_folder(spark, "raw")
    made = read(spark, sf_dir, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("slug"), "html")
    sinks.save_pages(made, folder)
    lines = spark.read.schema("value string, slug string").option("lineSep", "\n").text(folder)
    return lines.groupBy("slug").agg(F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


@query(f"""with {_SIDES}, k as (select distinct cast(season as varchar) as key, season as n from ranked union select concat('x', season), 3000 + season from ranked where season % 2 = 0)
  select key, row_number() over (order by n) as place from k""")
def season_order(spark, sf_dir):
    """Keys of seasons in a file's order: numbers ascending, then the others as they came. Places are given by ranges."""
    from tablesmith.operators.ordering import numbered

    years = standings.league_table(matches(spark, sf_dir)).select("season").distinct()
    keys = years.select(F.col("season").cast("string").alias("key"), F.lit(0).alias("place")).unionByName(years.filter("season % 2 = 0").select(F.concat(F.lit("x"), "season").alias("key"), F.col("season").alias("place")))
    ordered = keys.select("key", F.coalesce(F.col("key").try_cast("long"), F.lit(1 << 40)).alias("number"), "place")
    return numbered(ordered, ["number", "place"], "at").select("key", F.col("at").alias("place"))


@query(r"""select lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) as host, count(*) as n, cast(sum(length(html)) as bigint) as n_chars from pages where url is not null group by host""")
def source_pages(spark, sf_dir):
    """Pages read by the data source of known pages, by host."""
    page_source.register(spark)
    return spark.read.format("pages").option("known", f"{sf_dir}/pages.parquet").load().groupBy("host").agg(F.count("*").alias("n"), F.sum(F.length("html")).alias("n_chars"))
