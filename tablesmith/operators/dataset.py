"""Datasets of seasons in long form: raw tiers, normalised tiers and entries, replacement, and export."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions import league
from tablesmith.functions.js import js_number, js_parse_int

NUMBERS = {"pos": "pos", "played": "played", "won": "won", "drawn": "drawn", "lost": "lost", "goalsFor": "goals_for", "goalsAgainst": "goals_against", "points": "points"}
FLAGS = {"wasRelegated": "was_relegated", "wasPromoted": "was_promoted", "isExpansionTeam": "is_expansion_team", "wasReElected": "was_re_elected", "wasReprieved": "was_reprieved"}
#: Fields of an entry in the published order, with their columns.
ENTRY = {
    "pos": "pos", "team": "team", "played": "played", "won": "won", "drawn": "drawn", "lost": "lost", "goalsFor": "goals_for", "goalsAgainst": "goals_against",
    "goalDifference": "goal_difference", "goalAverage": "goal_average", "points": "points", "notes": "notes", **FLAGS,
}
KEY = ["source_rank", "season_key", "tier_key"]
RAW = "source_rank int, season_key string, season_ord int, tier_key string, tier_ord int, tier_json string"


@dataclass
class Dataset:
    """tiers: a row a tier or other block of a season; entries: a row a line of a table; both keyed by KEY."""

    tiers: DataFrame
    entries: DataFrame

    def where(self, condition: Column) -> Dataset:
        """Tiers under a condition on KEY columns, with their entries."""
        return Dataset(self.tiers.filter(condition), self.entries.filter(condition))


def raw_tiers(texts: DataFrame) -> DataFrame:
    """Blocks of texts(source_rank, value): JSON of {seasons: {...}} or of the seasons alone, in the text's order of keys."""
    blocks = "map<string, map<string, string>>"
    held = F.from_json("value", f"struct<seasons: {blocks}>")["seasons"]
    seasons = F.coalesce(held, F.when(F.get_json_object("value", "$.seasons").isNull(), F.from_json("value", blocks)))
    by_season = texts.select("source_rank", F.posexplode(F.map_entries(seasons)).alias("season_ord", "s"))
    return by_season.select("source_rank", F.col("s.key").alias("season_key"), "season_ord", F.posexplode(F.map_entries("s.value")).alias("tier_ord", "t")).select(
        "source_rank", "season_key", "season_ord", F.col("t.key").alias("tier_key"), "tier_ord", F.col("t.value").alias("tier_json")
    )


#: Optional numbers of an entry, which follow the required ones.
OPTIONAL = ("goalDifference", "goalAverage")


def _given(*names: str) -> Column:
    """An array of these fields of a row as they are."""
    return F.array(*[F.try_variant_get("row", f"$.{n}", "variant") for n in names])


def _number_text(value: Column) -> Column:
    """A boolean counts as 0 or 1, all else by its text."""
    boolean = F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "int").cast("string"))
    return F.coalesce(boolean, F.try_variant_get(value, "$", "string"))


def normalise_entries(rows: DataFrame, compat: bool = True) -> DataFrame:
    """Entries of rows(KEY, row_ord, row VARIANT): numbers, trimmed texts, flags from notes where no boolean is given.

    Rows that are no object or have no team fall away. Goal difference is goals for less goals against, whatever was
    given. Required numbers are 0 if blank; `bad_fields` names fields whose text is no number. A field is read and
    parsed once: fields of a kind are an array, so that one small expression serves all of them.
    """
    kept = [c for c in rows.columns if c != "row"]
    names = [*NUMBERS, *OPTIONAL]
    read = rows.filter(F.schema_of_variant("row").startswith("OBJECT")).select(
        *kept,
        F.transform(_given(*names), _number_text).alias("__texts"),
        F.transform(_given(*FLAGS), lambda v: F.when(F.schema_of_variant(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))).alias("__flags"),
        F.transform(_given("team", "notes"), lambda v: league.string_value(F.try_variant_get(v, "$", "string"))).alias("__names"),
    )
    parsed = read.select("*", F.transform("__texts", js_number).alias("__numbers"), F.get("__names", 0).alias("team"), F.get("__names", 1).alias("notes")).filter("team is not null")
    blank = lambda k: F.coalesce(F.get("__texts", k) == "", F.lit(True))
    numbers = {n: F.when(blank(k), F.lit(0.0) if n in NUMBERS else F.lit(None).cast("double")).otherwise(F.get("__numbers", k)) for k, n in enumerate(names)}
    bad = [F.when(~blank(k) & F.get("__numbers", k).isNull(), F.lit(n)) for k, n in enumerate(names)]
    notes = F.col("notes")
    derived = (league.noted_relegated(notes), league.noted_promoted(notes), league.noted_expansion(notes), league.noted_re_elected(notes), league.noted_reprieved(notes, compat))
    numbered = parsed.select(
        *kept,
        "team",
        *[numbers[n].alias(c) for n, c in NUMBERS.items()],
        numbers["goalDifference"].alias("given_goal_difference"),
        numbers["goalAverage"].alias("goal_average"),
        "notes",
        *[F.coalesce(F.get("__flags", k), d).alias(c) for k, (c, d) in enumerate(zip(FLAGS.values(), derived, strict=True))],
        F.array_compact(F.array(*bad)).alias("bad_fields"),
    )
    return numbered.withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))


def strict(entries: DataFrame) -> DataFrame:
    """entries, failing on the first one with a field that is no number."""
    fine = F.when(F.size("bad_fields") > 0, F.raise_error(F.concat(F.lit("not a number: "), F.array_join("bad_fields", ", ")))).otherwise(F.lit(True))
    return entries.filter(fine.cast("boolean"))


def _names(json: Column) -> Column:
    """Trimmed different names of a JSON array, in order; null if it is no array."""
    listed = F.when(json.startswith("["), F.from_json(json, "array<string>"))
    trimmed = F.transform(listed, lambda x: league.string_value(x))
    return F.array_distinct(F.filter(trimmed, lambda x: x.isNotNull()))


def _flagged(flag: str) -> Column:
    rows = F.array_sort(F.collect_list(F.when(F.col(flag), F.struct("row_ord", "team"))))
    return F.array_distinct(F.transform(rows, lambda r: r["team"]))


def normalise(raw: DataFrame, compat: bool = True) -> Dataset:
    """The Dataset of raw tiers. Blocks that are neither array nor object fall away.

    tier_kind is array or object. Objects get their season (the key's number if theirs is none, else 0) and lists of
    promoted and relegated names; an empty list is filled with the teams that are flagged so. `extra` keeps all other
    fields as JSON, in order. `listed_*` tells whether a list was given at all.
    """
    whole = F.ltrim("tier_json")
    kinds = raw.withColumn("tier_kind", F.when(whole.startswith("["), "array").when(whole.startswith("{"), "object")).filter("tier_kind is not null")
    table = F.when(F.col("tier_kind") == "array", F.col("tier_json")).otherwise(F.get_json_object("tier_json", "$.table"))
    lines = kinds.select(*KEY, F.posexplode(F.from_json(F.when(table.startswith("["), table), "array<string>")).alias("row_ord", "line"))
    entries = normalise_entries(lines.select(*KEY, "row_ord", F.try_parse_json("line").alias("row")), compat)
    flagged = entries.groupBy(*KEY).agg(F.count("*").cast("int").alias("n_rows"), _flagged("was_promoted").alias("flag_promoted"), _flagged("was_relegated").alias("flag_relegated"))
    is_object = F.col("tier_kind") == "object"
    given = {side: _names(F.get_json_object("tier_json", f"$.{side}")) for side in ("promoted", "relegated")}
    key_number = js_parse_int(F.col("season_key"))
    own = F.coalesce(F.get_json_object("tier_json", "$.season"), F.col("season_key"))
    inner = F.from_json("tier_json", "map<string, string>")
    extra = F.map_filter(inner, lambda k, _: ~k.isin("table", "season", "promoted", "relegated"))
    none = F.array().cast("array<string>")
    tiers = kinds.join(flagged, KEY, "left").select(
        "source_rank", "season_key", key_number.cast("int").alias("season_num"), "season_ord", "tier_key", "tier_ord", "tier_kind",
        F.when(is_object, F.coalesce(js_parse_int(own), key_number, F.lit(0)).cast("int")).alias("tier_season"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        *[F.when(is_object, F.when(F.size(F.coalesce(g, none)) > 0, g).otherwise(F.coalesce(f"flag_{side}", none))).alias(side) for side, g in given.items()],
        *[(is_object & g.isNotNull()).alias(f"listed_{side}") for side, g in given.items()],
        F.when(is_object, extra).alias("extra"),
    )
    return Dataset(tiers, entries)


def has_data() -> Column:
    """Whether a block has rows, promoted or relegated names, or season metadata."""
    metadata = F.coalesce(F.size(F.from_json(F.col("extra")["seasonMetadata"], "map<string, string>")), F.lit(0)) > 0
    return (F.col("n_rows") > 0) | (F.coalesce(F.size("promoted"), F.lit(0)) > 0) | (F.coalesce(F.size("relegated"), F.lit(0)) > 0) | F.coalesce(metadata, F.lit(False))


def replace(base: Dataset, new: Dataset, grain: tuple[str, ...] = ("season_key", "tier_key")) -> Dataset:
    """base with all that new has under the same key replaced: by tier, or by whole season with the grain ("season_key",)."""
    keys = new.tiers.select(*grain).distinct()
    return Dataset(*(old.join(keys, list(grain), "left_anti").select(old.columns).unionByName(added) for old, added in ((base.tiers, new.tiers), (base.entries, new.entries))))


def tier_json(data: Dataset) -> DataFrame:
    """(season_key, season_ord, tier_key, tier_ord, json) of each block, its fields in the published order."""
    number = lambda c: F.when(F.col(c) == F.floor(c), F.col(c).cast("long").cast("string")).otherwise(F.col(c).cast("string"))
    text = lambda c: F.coalesce(F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2), F.lit("null"))
    pieces = []
    for name, column in ENTRY.items():
        value = text(column) if column in ("team", "notes") else F.col(column).cast("string") if column in FLAGS.values() else number(column)
        pieces.append(F.concat(F.lit(f'"{name}":'), F.coalesce(value, F.lit("null"))))
    row = F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("row_ord", "line"))), lambda r: r["line"])
    tables = data.entries.select(*KEY, "row_ord", row.alias("line")).groupBy(*KEY).agg(F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]")).alias("table"))
    table = F.coalesce("table", F.lit("[]"))
    kept = F.array_join(F.transform(F.map_entries("extra"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), json_value(e["value"]))), ",")
    parts = F.array(F.nullif(kept, F.lit("")), F.concat(F.lit('"season":'), F.col("tier_season").cast("string")), F.concat(F.lit('"table":'), table), *[F.concat(F.lit(f'"{s}":'), F.to_json(s)) for s in ("relegated", "promoted")])
    whole = F.when(F.col("tier_kind") == "array", table).otherwise(F.concat(F.lit("{"), F.array_join(F.array_compact(parts), ","), F.lit("}")))
    return data.tiers.join(tables, KEY, "left").select("season_key", "season_ord", "tier_key", "tier_ord", whole.alias("json"))


def json_value(text: Column) -> Column:
    """A value that was read as text, as JSON again: objects, arrays, numbers and literals as they are, others quoted."""
    plain = F.trim(text).rlike(r"^(\{.*\}|\[.*\]|-?\d+(\.\d+)?([eE][+-]?\d+)?|true|false|null)$")
    quoted = F.to_json(F.array(text))
    return F.when(text.isNull(), "null").when(plain, text).otherwise(quoted.substr(F.lit(2), F.length(quoted) - 2))
