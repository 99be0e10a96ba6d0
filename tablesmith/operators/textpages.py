"""League tables of fixed-column text: lines to rows with SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.league import TEXT_NOTES, title_case

#: Figures of a line in order; lines without a goal difference have one figure less.
STATS = ("played", "home_won", "home_drawn", "home_lost", "home_for", "home_against", "away_won", "away_drawn", "away_lost", "away_for", "away_against", "goal_difference", "points")
#: What table_rows() adds, in the place of columns of these names.
ROW = ("pos", "team", "played", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points", "was_promoted", "was_relegated", "meta")
TITLE_LINE = r"(?i)\bP\s+W\s+D\s+L\s+F\s+A\s+W\s+D\s+L\s+F\s+A\b"
NOTE_LINE = r"^[+*#@^]"


def table_rows(lines: DataFrame, n_lines: Column, first_division: Column) -> DataFrame:
    """lines(line, ...) with the parts of a table's row; those that are none are dropped.

    A row is a place, a team, 12 or 13 figures, and markers. The figures are the first 12 whole numbers in a row after
    the place, 13 if one more follows. A team in capitals goes up in the upper half and down in the lower, where half
    of n_lines counts as half of the table; the first division promotes none. Null lines are no rows. The caller's
    columns stay, but for those of ROW, which the row's own replace.
    """
    kept = [c for c in lines.columns if c not in ROW]
    # One pattern reads a line once; its parts come back between separators, which lines with no row lack.
    figures = "((?:-?[0-9]+ ){11}-?[0-9]+)(?: (-?[0-9]+)(?= |$))?(?= |$)"
    pattern = rf"^([^ ]*[0-9][^ ]*) ([^ ]+(?: [^ ]+)*?) {figures}((?: [^ ]+)*)$"
    tidy = F.trim(F.regexp_replace(F.regexp_replace("line", "\\x01", " "), "\\s+", " "))
    split = F.split(F.regexp_replace(tidy, pattern, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01")
    # Filtered within the generator, so that no part of it is evaluated again.
    rows = lines.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("own"), F.col("line").alias("line"), n_lines.alias("n"), first_division.alias("first"), F.explode(F.filter(F.array(split), lambda p: F.size(p) == 5)).alias("p"))
    place = F.regexp_replace(F.col("p")[0], r"\D", "").try_cast("long")
    numbers = F.transform(F.split(F.concat(F.col("p")[2], F.when(F.col("p")[3] != "", F.concat(F.lit(" "), F.col("p")[3])).otherwise("")), " "), lambda t: t.try_cast("long"))
    markers = F.filter(F.split(F.trim(F.col("p")[4]), " "), lambda m: m != "")
    parts = rows.select("own", "line", "n", "first", place.alias("place"), F.col("p")[1].alias("team"), numbers.alias("v"), markers.alias("markers"))
    n_lines, first_division, wide = F.col("n"), F.col("first"), F.size("v") == len(STATS)
    stat = {name: F.col("v")[k] for k, name in enumerate(STATS[:11])}
    total = lambda side: stat[f"home_{side}"] + stat[f"away_{side}"]
    goals_for, goals_against = total("for"), total("against")
    capital, upper_half = F.col("team") == F.upper("team"), F.col("place") <= F.floor(n_lines / 2)
    side = lambda s: F.struct(*[stat[f"{s}_{k}"].alias(k) for k in ("won", "drawn", "lost", "for", "against")])
    record = F.struct(side("home").alias("home"), side("away").alias("away"), "markers", (capital & (F.length("team") > 1)).alias("highlighted"), F.col("line").alias("raw_line"))
    return parts.select(
        *[F.col("own")[c].alias(c) for c in kept], F.col("place").alias("pos"), "team", stat["played"].alias("played"), total("won").alias("won"), total("drawn").alias("drawn"), total("lost").alias("lost"),
        goals_for.alias("goals_for"), goals_against.alias("goals_against"), F.when(wide, F.col("v")[11]).otherwise(goals_for - goals_against).alias("goal_difference"),
        F.element_at("v", -1).alias("points"), (capital & upper_half & ~first_division).alias("was_promoted"), (capital & ~upper_half).alias("was_relegated"), record.alias("meta"),
    )


def competitions(blocks: DataFrame, compat: bool = True) -> tuple[DataFrame, DataFrame]:
    """Competitions and rows of blocks(page_id, block_no, text), the pre-formatted parts of pages in order.

    A block counts if it has a line of column titles after its heading and a row below. Rows go on until a line that is
    neither row, note nor blank. The first block that counts is the page's first division. Notes of a row are those of
    its markers. compat: promotion and relegation come from capitals alone; else notes may also tell them.

    Competitions: (page_id, block_no, heading, league, season, season_slug, first_division, notes); rows: (page_id,
    block_no, row_ord, fields, notes, flags, meta).
    """
    key = ["page_id", "block_no"]
    tidy = F.regexp_replace("text", r"\r\n?", "\n")
    lines = blocks.select(*key, F.posexplode(F.split(tidy, "\n")).alias("line_no", "line")).withColumn("trimmed", F.trim(F.regexp_replace("line", r"\s+", " ")))
    block = Window.partitionBy(*key)
    lines = lines.withColumn("n_lines", F.count("*").over(block)).withColumn("heading_at", F.min(F.when(F.col("trimmed") != "", F.col("line_no"))).over(block))
    titles = (F.col("line_no") > F.col("heading_at")) & F.col("line").rlike(TITLE_LINE)
    lines = lines.withColumn("titles_at", F.min(F.when(titles, F.col("line_no"))).over(block)).filter("titles_at is not null")
    body = lines.filter("line_no > titles_at and trimmed <> ''")
    rows = table_rows(body.filter(~F.col("trimmed").rlike(NOTE_LINE)).select(*key, "line_no", "line", "n_lines"), F.col("n_lines"), F.lit(False))
    kinds = body.join(rows.select(*key, "line_no", F.lit(True).alias("is_row")), [*key, "line_no"], "left").withColumn("is_note", F.col("trimmed").rlike(NOTE_LINE))
    ends = kinds.filter(~F.col("is_note") & (F.col("is_row").isNull() | ~F.col("trimmed").rlike("^[0-9]"))).groupBy(*key).agg(F.min("line_no").alias("end_at"))
    inside = lambda f: f.join(ends, key, "left").filter("end_at is null or line_no < end_at").drop("end_at")
    rows = inside(rows)
    note = F.struct("line_no", F.regexp_extract("trimmed", r"^([+*#@^]+)", 1).alias("symbol"), F.trim(F.regexp_replace("trimmed", r"^[+*#@^]+", "")).alias("text"))
    notes = inside(kinds.filter("is_note")).groupBy(*key).agg(F.array_sort(F.collect_list(note)).alias("notes"))
    good = rows.select(*key).distinct().withColumn("first_division", F.row_number().over(Window.partitionBy("page_id").orderBy("block_no")) == 1)
    heads = lines.filter("line_no = heading_at").select(*key, F.trim("line").alias("heading")).join(good, key).join(notes, key, "left")
    parts = F.split("heading", " - ")
    season = F.when(F.size(parts) > 1, F.trim(F.element_at(parts, -1)))
    heads = heads.withColumn("season", season).withColumn("league", F.when(F.size(parts) > 1, F.trim(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), " - "))).otherwise(F.col("heading")))
    empty = F.array().cast("array<struct<line_no:int,symbol:string,text:string>>")
    heads = heads.withColumn("season_slug", season_slug(F.col("season"))).withColumn("notes", F.coalesce("notes", empty))
    told = rows.join(heads.select(*key, "first_division", F.col("notes").alias("all_notes")), key)
    texts = F.flatten(F.transform("meta.markers", lambda m: F.transform(F.filter("all_notes", lambda n: n["symbol"] == m), lambda n: n["text"])))
    told = told.withColumn("notes", F.nullif(F.array_join(texts, " "), F.lit("")))
    said = {flag: F.coalesce(F.lower("notes").rlike(pattern), F.lit(False)) for flag, pattern in TEXT_NOTES.items()}
    promoted, relegated = F.col("was_promoted") & ~F.col("first_division"), F.col("was_relegated")
    told = told.withColumn("was_promoted", promoted if compat else promoted | said["was_promoted"]).withColumn("was_relegated", relegated if compat else relegated | said["was_relegated"])
    told = told.withColumns({flag: said[flag] for flag in ("was_re_elected", "was_reprieved", "is_expansion_team")}).withColumn("team", title_case(F.col("team")))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("line_no")) - 1
    return heads.select(*key, "heading", "league", "season", "season_slug", "first_division", "notes"), told.withColumn("row_ord", place).drop("line", "line_no", "n_lines", "all_notes", "first_division")


def season_slug(season: Column) -> Column:
    """A season's label as digits and dashes: 1908/09 gives 1908-09; without digits, words joined by dashes."""
    dashed = F.regexp_replace(F.regexp_replace(F.regexp_replace(season, r"[^\d/\\-]+", ""), r"[/\\]", "-"), "--+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(dashed, "^-|-$", ""), F.lit("")), F.nullif(F.regexp_replace(season, r"\s+", "-"), F.lit("")))


def page_seasons(heads: DataFrame) -> DataFrame:
    """(page_id, seasons, season_slug): a page's different labels in order, and its first slug."""
    labels = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("season") != "", F.struct("block_no", "season")))), lambda r: r["season"]))
    return heads.groupBy("page_id").agg(labels.alias("seasons"), F.min_by("season_slug", F.when(F.col("season_slug").isNotNull(), F.col("block_no"))).alias("season_slug"))
