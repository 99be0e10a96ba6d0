"""Validation: rules over datasets, one issue a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.js import js_number
from tablesmith.functions.league import describe_tier, is_numbered_tier, is_tier, normal_name, season_number
from tablesmith.operators.dataset import KEY, Dataset

ISSUE = ["source_rank", "season_key", "tier_key", "rule", "rule_ord", "message"]


def duplicates(rows: DataFrame, keys: list[str], value: Column, order: str, normal: Column | None = None) -> DataFrame:
    """(keys..., value, place, n): values that occur more than once by their normal form, in the spelling that comes first.

    Null forms are no values. Other columns are ignored; an empty table gives no rows.
    """
    form = value if normal is None else normal
    found = rows.select(*keys, form.alias("__form"), value.alias("__value"), F.col(order).alias("__order")).filter("__form is not null").groupBy(*keys, "__form")
    return found.agg(F.min_by("__value", "__order").alias("value"), F.min("__order").alias("place"), F.count("*").alias("n")).filter("n > 1").drop("__form")


def with_first(rows: DataFrame, keys: list[str], form: Column, order: str) -> DataFrame:
    """rows that repeat an earlier row's form, with that row's place as `first_row`, in the place of any column of that name.

    Null forms repeat nothing. Rows of equal form and place are all first ones. Columns stay; an empty table gives no rows.
    """
    same = Window.partitionBy(*keys, "__form")
    marked = rows.withColumn("__form", form).filter("__form is not null").withColumn("first_row", F.min(order).over(same))
    return marked.filter(F.col(order) > F.col("first_row")).drop("__form")


def _plain(value: Column) -> Column:
    return F.when(value == F.floor(value), value.cast("long").cast("string")).otherwise(value.cast("string"))


#: The rules in their order, with what an issue says before the names of teams or values, if it has some.
RULES = {
    "missing-season-data": "No tier table/promoted/relegated data detected for this season",
    "empty-tier": "Tier has no table rows or outcome lists",
    "season-mismatch": "Tier season (%d) does not match key %d",
    "duplicate-teams": "Duplicate teams detected: ",
    "duplicate-positions": "Duplicate position values detected: ",
    "match-count-mismatch": "Played totals do not equal won+drawn+lost for: ",
    "goal-diff-mismatch": "Goal difference does not equal GF-GA for: ",
    "promoted-mismatch": "Promoted list missing flagged teams: ",
    "promoted-unknown": "Promoted list includes teams not in table: ",
    "relegated-mismatch": "Relegated list missing flagged teams: ",
    "relegated-unknown": "Relegated list includes teams not in table: ",
}


def _repeated(values: Column, forms: Column) -> Column:
    """The values whose form comes again, each form once, in the spelling that comes first. Null forms never do."""
    first = F.transform(forms, lambda f, i: f.isNotNull() & (F.array_position(forms, f) == i + 1) & (F.size(F.filter(forms, lambda g: g == f)) > 1))
    return F.transform(F.filter(F.arrays_zip(values.alias("v"), first.alias("f")), lambda x: x["f"]), lambda x: x["v"])


def _gaps(rows: Column, side: str) -> tuple[Column, Column]:
    """Teams of a tier's rows that are flagged and not listed, and listed teams that are in no row, by normal name."""
    listed, names = F.transform(side, lambda t: normal_name(t)), F.transform(rows, lambda r: r["name"])
    lacking = F.transform(F.filter(rows, lambda r: r[f"was_{side}"] & ~F.array_contains(listed, r["name"])), lambda r: r["team"])
    return lacking, F.filter(side, lambda t: ~F.array_contains(names, normal_name(t)))


def lint(data: Dataset, raw_differences: bool = False) -> DataFrame:
    """Issues of a normalised dataset, a row each (ISSUE).

    A season without any data has one issue and no others. raw_differences: compare goal differences as they were
    given; the normalised ones are right by construction. All rules look at a tier once, with its rows as an array: a
    tier's table is one JSON text to begin with.
    """
    given = "given_goal_difference" if raw_differences else "goal_difference"
    row = F.struct("row_ord", "team", normal_name(F.col("team")).alias("name"), "pos", (F.col("played") != F.col("won") + F.col("drawn") + F.col("lost")).alias("odd_played"), (F.col(given) != F.col("goals_for") - F.col("goals_against")).alias("odd_goals"), "was_promoted", "was_relegated")
    tables = data.entries.groupBy(*KEY).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    own = data.tiers.select(*KEY, "season_num", "tier_ord", "tier_season", "n_rows", "promoted", "relegated", "listed_promoted", "listed_relegated").join(tables, KEY, "left")
    tier = is_tier(F.col("tier_key"))
    content = tier & ((F.col("n_rows") > 0) | (F.coalesce(F.size("promoted"), F.lit(0)) > 0) | (F.coalesce(F.size("relegated"), F.lit(0)) > 0))
    season = Window.partitionBy("source_rank", "season_key")
    own = own.withColumn("content", content).withColumn("any", F.max("content").over(season))
    # A season without data has its issue at the first of its blocks, of whatever kind that is.
    own = own.withColumn("first", F.row_number().over(season.orderBy("tier_ord", "tier_key")) == 1)
    named = lambda names: F.when(F.size(names) > 0, F.array_join(names, ", "))
    rows = F.coalesce("rows", F.array().cast(own.schema["rows"].dataType))
    teams = lambda kept: F.transform(F.filter(rows, kept), lambda r: r["team"])
    values = F.transform(rows, lambda r: _plain(r["pos"]))
    found: dict[str, Column] = {
        "empty-tier": F.when(~F.col("content"), F.lit("")),
        "season-mismatch": F.when(F.col("tier_season") != F.col("season_num"), F.format_string(RULES["season-mismatch"], "tier_season", "season_num")),
        "duplicate-teams": named(_repeated(F.transform(rows, lambda r: r["team"]), F.transform(rows, lambda r: r["name"]))),
        "duplicate-positions": named(_repeated(values, values)),
        "match-count-mismatch": named(teams(lambda r: r["odd_played"])),
        "goal-diff-mismatch": named(teams(lambda r: r["odd_goals"])),
    }
    for side in ("promoted", "relegated"):
        lacking, unknown = _gaps(rows, side)
        found[f"{side}-mismatch"], found[f"{side}-unknown"] = (F.when(F.col(f"listed_{side}"), named(names)) for names in (lacking, unknown))
    order = list(RULES)
    said = lambda rule, detail: detail if rule == "season-mismatch" else F.concat(F.lit(RULES[rule]), detail)
    details = {order[0]: F.when(~F.col("any") & F.col("first"), F.lit("")), **{rule: F.when(F.col("any") & tier, detail) for rule, detail in found.items()}}
    issue = [F.struct(F.lit(rule).alias("rule"), F.lit(k + 1).alias("rule_ord"), said(rule, details[rule]).alias("message")) for k, rule in enumerate(order)]
    each = own.select(*KEY, F.explode(F.filter(F.array(*issue), lambda x: x["message"].isNotNull())).alias("issue")).select(*KEY, "issue.*")
    return each.withColumn("tier_key", F.when(F.col("rule_ord") > 1, F.col("tier_key")))


def outcome_gaps(tiers: DataFrame, rows: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
    """Flagged teams that the list lacks, and listed teams that the table lacks, by normal name: (KEY, row_ord, team) each."""
    names = tiers.select(*KEY, F.posexplode(side).alias("row_ord", "team")).withColumn("name", normal_name(F.col("team")))
    own = rows.join(tiers.select(*KEY), KEY, "left_semi").select(*KEY, "row_ord", "team", f"was_{side}").withColumn("name", normal_name(F.col("team")))
    missing = own.filter(f"was_{side}").join(names.select(*KEY, "name"), [*KEY, "name"], "left_anti")
    unknown = names.join(own.select(*KEY, "name"), [*KEY, "name"], "left_anti")
    return missing.select(*KEY, "row_ord", "team"), unknown.select(*KEY, "row_ord", "team")


def issue_order() -> list[Column]:
    """By season number, other seasons after them in the order of letters; then tier name (tierless last) and rule."""
    letters = lambda c: F.collate(F.col(c), "UNICODE").asc_nulls_last()
    return [season_number(F.col("season_key")).asc_nulls_last(), letters("season_key"), letters("tier_key"), F.col("rule_ord")]


def totals(issues: DataFrame) -> DataFrame:
    """(rule, n): how many issues each rule has."""
    return issues.groupBy("rule").agg(F.count("*").alias("n"))


def summary(issues: DataFrame) -> dict[str, int]:
    """How many issues there are, of how many seasons; of overview issues, how many are errors and warnings."""
    figures = [F.count("*").alias("issues"), F.countDistinct("season_key").alias("seasons")]
    if "severity" in issues.columns:
        figures += [F.count_if(F.col("severity") == kind).alias(f"{kind}s") for kind in ("error", "warning")]
    return issues.agg(*figures).first().asDict()


def tier_sequence(tiers: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., found): keys whose numbered tiers are not 1, 2, 3 and so on, with what was found."""
    number = F.substring("tier_key", 5, 9).try_cast("int")
    ranked = tiers.filter(is_numbered_tier(F.col("tier_key"))).withColumn("number", number)
    ranked = ranked.withColumn("expected", F.row_number().over(Window.partitionBy(*keys).orderBy("number")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("number", "tier_key"))), lambda r: r["tier_key"])
    return ranked.groupBy(*keys).agg(F.bool_or(F.col("number") != F.col("expected")).alias("odd"), F.array_join(listed, ", ").alias("found")).filter("odd").drop("odd")


def lint_overview(raw: DataFrame) -> DataFrame:
    """(season_key, severity, message, place) of raw tiers as they are, without normalising: structure, counts, rows."""
    key = ["season_key"]
    block = raw.withColumn("v", F.try_parse_json("tier_json"))
    info = block.filter("tier_key = 'seasonInfo'").select("season_key", F.try_variant_get("v", "$.tableCount", "int").alias("declared"), F.lit(True).alias("has_info"))
    number = F.substring("tier_key", 5, 9).try_cast("int")
    tiers = block.filter(is_numbered_tier(F.col("tier_key"))).withColumn("number", number)
    by_season = Window.partitionBy("season_key")
    tiers = tiers.withColumn("index", F.row_number().over(by_season.orderBy("number")) - 1).withColumn("actual", F.count("*").over(by_season))
    label = F.concat(describe_tier(F.col("tier_key")), F.lit(" ("), F.coalesce(F.try_variant_get("v", "$.title", "string"), F.lit("(untitled league)")), F.lit(")"))
    tiers = tiers.withColumn("label", label)
    seasons = raw.select("season_key").distinct().join(info, key, "left").join(tiers.groupBy("season_key").agg(F.count("*").alias("actual")), key, "left").fillna({"actual": 0})
    at = lambda frame, severity, message, *place: frame.select("season_key", F.lit(severity).alias("severity"), message.alias("message"), F.array(*[F.lit(p) if isinstance(p, int) else F.col(p).cast("int") for p in place]).alias("place"))
    out = [at(seasons.filter("has_info is null"), "error", F.lit("Missing seasonInfo block"), 0)]
    out.append(at(seasons.filter("actual = 0"), "warning", F.lit("No tier entries discovered for season"), 1))
    out.append(at(seasons.filter("declared <> actual"), "warning", F.format_string("Table count mismatch: seasonInfo.tableCount=%d, actual=%d", "declared", "actual"), 2))
    out.append(at(tier_sequence(tiers, key), "warning", F.format_string("Tier keys are non-sequential: found [%s]", "found"), 3))
    table = F.try_variant_get("v", "$.table", "string")
    tiers = tiers.withColumn("rows", F.from_json(F.when(F.ltrim(table).startswith("["), table), "array<string>"))
    out.append(at(tiers.filter("rows is null"), "error", F.concat("label", F.lit(": table is missing or not an array")), 4, "index"))
    tiers = tiers.filter("rows is not null")
    out.append(at(tiers.filter("size(rows) = 0"), "warning", F.concat("label", F.lit(": table is empty")), 4, "index", 0))
    meta = tiers.withColumn("ti", F.try_variant_get("v", "$.seasonMetadata.tableIndex", "int")).withColumn("tc", F.try_variant_get("v", "$.seasonMetadata.tableCount", "int"))
    out.append(at(meta.filter("ti <> index"), "warning", F.format_string("%s: seasonMetadata.tableIndex=%d but expected %d", "label", "ti", "index"), 4, "index", 1))
    out.append(at(meta.filter("tc <> actual"), "warning", F.format_string("%s: seasonMetadata.tableCount=%d but season has %d tiers", "label", "tc", "actual"), 4, "index", 2))
    rows = tiers.select("season_key", "label", "index", F.posexplode("rows").alias("row", "line")).withColumn("r", F.try_parse_json("line"))
    rows = rows.withColumn("team", F.trim(F.coalesce(F.try_variant_get("r", "$.team", "string"), F.lit("")))).withColumn("pos", F.try_variant_get("r", "$.pos", "string")).withColumn("n", js_number(F.col("pos")))
    at_row = F.concat("label", F.lit(" row "), (F.col("row") + 1).cast("string"))
    out.append(at(rows.filter("team = ''"), "error", F.concat(at_row, F.lit(": missing team name")), 4, "index", 3, "row", 0))
    out.append(at(rows.filter("n is null"), "error", F.concat(at_row, F.lit(": missing or invalid pos value")), 4, "index", 3, "row", 1))
    out.append(at(rows.filter("n <> floor(n)"), "warning", F.concat(at_row, F.lit(": pos is not an integer ("), "pos", F.lit(")")), 4, "index", 3, "row", 1))
    pair = F.format_string(" (rows %d and %d)", F.col("first_row") + 1, F.col("row") + 1)
    again = with_first(rows.filter("n = floor(n)"), ["season_key", "index"], F.col("n"), "row")
    out.append(at(again, "error", F.concat("label", F.lit(": duplicate position "), F.col("n").cast("long").cast("string"), pair), 4, "index", 3, "row", 2))
    again = with_first(rows.filter("team <> ''"), ["season_key", "index"], normal_name(F.col("team")), "row")
    out.append(at(again, "warning", F.concat("label", F.lit(': duplicate team name "'), "team", F.lit('"'), pair), 4, "index", 3, "row", 3))
    return reduce(DataFrame.unionByName, out)
