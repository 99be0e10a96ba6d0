"""Column expressions of the league domain: names, notes, headers, seasons, rules and war years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablesmith.functions.js import WHITE, js_number, js_parse_float, js_parse_int, js_trim

#: Header texts of each field.
HEADERS = {
    "pos": ("pos", "position", "no"),
    "team": ("team", "club", "side"),
    "played": ("pld", "p", "played", "games played"),
    "won": ("w", "won"),
    "drawn": ("d", "draw", "drawn"),
    "lost": ("l", "lost"),
    "goalsFor": ("gf", "goals for", "f", "for"),
    "goalsAgainst": ("ga", "goals against", "a", "against"),
    "goalDifference": ("gd", "goal difference", "difference"),
    "goalAverage": ("gav", "gavg", "goal average", "ga v", "g av"),
    "points": ("pts", "points", "points total"),
    "notes": ("notes", "remarks"),
}
#: Spans of seasons without play, when sources are merged and when pages are fetched.
WAR_MERGE = ((1915, 1918), (1940, 1945))
WAR_FETCH = ((1915, 1919), (1940, 1946))
#: Note patterns of tables and of fixed-column pages; reprieved has the sources' own spellings.
REPRIEVED = r"repriv(?:ed|e)d from re-election"
REPRIEVED_TABLE = r"reprived from re-election"
REPRIEVED_TEXT = r"reprie(?:v|e)d from re-?election"
REPRIEVED_RIGHT = r"repriev(?:ed|al) from re-?election"
TEXT_NOTES = {
    "was_promoted": "(?i)promot",
    "was_relegated": "(?i)relegat|demoted to the|dropped to the|sent down to",
    "was_re_elected": "re-?elected",
    "was_reprieved": REPRIEVED_TEXT,
    "is_expansion_team": "(?i)expansion|new club|admitted|joined league|first time in the league",
}
TRUTHY = ("true", "1", "yes", "y")


def header_field(label: Column) -> Column:
    """The field that a header's text names; texts of no field stay as they are, in lower case."""
    text = F.regexp_replace(F.regexp_replace(F.lower(js_trim(label)), f"[{WHITE}]+", " "), "[.]", "")
    found = F.when(F.lit(False), F.lit(""))
    for field, names in HEADERS.items():
        match = text.isin(*names)
        found = found.when(match | text.contains("qualification") | text.contains("relegation") if field == "notes" else match, field)
    return found.otherwise(text)


def string_value(value: Column) -> Column:
    """Trimmed text, null if blank."""
    return F.nullif(js_trim(value), F.lit(""))


def required_number(value: Column) -> Column:
    """A number that must be there: null and blank are 0; text that is no number stays null, for the bad rows."""
    return F.when(value.isNull() | (value == ""), F.lit(0.0)).otherwise(js_number(value))


def optional_number(value: Column) -> Column:
    return F.when(value == "", F.lit(None).cast("double")).otherwise(js_number(value))


def cell_number(value: Column, unicode_minus: bool) -> Column:
    """The number of a table cell, other characters dropped; unicode_minus: minus signs and dashes count as minus."""
    text = F.regexp_replace(value, "[−–—]", "-") if unicode_minus else value
    return js_parse_float(F.regexp_replace(text, r"[^\d.-]", ""))


def truthy(value: Column) -> Column:
    return F.coalesce(F.lower(js_trim(value)).isin(*TRUTHY), F.lit(False))


def _noted(notes: Column, pattern: str) -> Column:
    return F.coalesce(F.lower(notes).rlike(pattern), F.lit(False))


def noted_relegated(notes: Column) -> Column:
    return _noted(notes, "relegat|demoted to the")


def noted_promoted(notes: Column) -> Column:
    return _noted(notes, "promot")


def noted_expansion(notes: Column) -> Column:
    return _noted(notes, "expansion|new club|admitted|joined league")


def noted_re_elected(notes: Column) -> Column:
    return _noted(notes, "re-elected")


def noted_reprieved(notes: Column, compat: bool = True) -> Column:
    """compat: the misspelt pattern of the data's own conventions, else the right spelling."""
    return _noted(notes, REPRIEVED if compat else REPRIEVED_RIGHT)


def normal_name(name: Column) -> Column:
    return F.lower(js_trim(name))


def title_case(name: Column) -> Column:
    """First letter upper, all others lower."""
    return F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substring(name, 2, 1 << 30)))


def is_first_division(name: Column) -> Column:
    return F.coalesce(F.lower(name).contains("first"), F.lit(False))


def output_slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def encoding_of(content_type: Column) -> Column:
    return F.nullif(F.lower(js_trim(F.regexp_extract(content_type, "(?i)charset=([^;]+)", 1))), F.lit(""))


def season_number(key: Column) -> Column:
    return js_parse_int(key)


def slug_season_key(slug: Column) -> Column:
    """The first four digits of a slug, else the slug, else a stand-in."""
    return F.coalesce(F.nullif(F.regexp_extract(slug, r"(\d{4})", 1), F.lit("")), F.nullif(slug, F.lit("")), F.lit("unknown-season"))


def _end_year(year: Column) -> Column:
    """The two last digits of the next year; the whole of it at a century's turn."""
    after = year + 1
    return F.when(after % 100 == 0, after.cast("string")).otherwise(F.lpad((after % 100).cast("string"), 2, "0"))


def promotion_slug(year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), _end_year(year), F.lit("_Football_League"))


def overview_slug(year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("–"), _end_year(year), F.lit("_in_English_football"))


def season_labels(year: Column) -> dict[str, Column]:
    """Parts of a season's label for URL templates, by placeholder."""
    start, end = year.cast("string"), (year + 1).cast("string")
    short = F.lpad(((year + 1) % 100).cast("string"), 2, "0")
    dash = F.concat(start, F.lit("-"), short)
    return {
        "seasonSlug": dash,
        "seasonFull": F.concat(start, F.lit("-"), end),
        "seasonUnderscore": F.concat(start, F.lit("_"), short),
        "seasonCompact": F.concat(start, short),
        "seasonLabel": F.concat(start, F.lit("/"), short),
        "startYear": start,
        "endYear": end,
        "endYearShort": short,
    }


def points_for_win(season: Column) -> Column:
    return F.when(season <= 1980, 2).otherwise(3)


def by_goal_average(season: Column) -> Column:
    """Whether goal average, and not goal difference, breaks ties."""
    return season <= 1975


def goal_average(goals_for: Column, goals_against: Column) -> Column:
    return F.when(goals_against == 0, goals_for.cast("double")).otherwise(goals_for.cast("double") / F.nullif(goals_against, F.lit(0)))


def relegated_count(season: Column) -> Column:
    return F.when(season <= 1897, 0).when(season <= 1980, 2).when(season <= 1991, 3).when(season == 1995, 4).otherwise(3)


def promoted_count(season: Column) -> Column:
    return F.when(season <= 1897, 0).when(season <= 1980, 2).when(season <= 1991, 3).when(season == 1995, 2).otherwise(3)


def _within(season: Column, spans: tuple[tuple[int, int], ...]) -> Column:
    (a, b), (c, d) = spans
    return F.coalesce(season.between(a, b) | season.between(c, d), F.lit(False))


def war_season_of_merge(season: Column) -> Column:
    return _within(season, WAR_MERGE)


def war_season_of_fetch(season: Column) -> Column:
    return _within(season, WAR_FETCH)


def is_tier(key: Column) -> Column:
    return key.rlike("(?i)^tier")


def is_numbered_tier(key: Column) -> Column:
    return key.rlike(r"^tier\d+$")


def begins_with_numbered_tier(key: Column) -> Column:
    return key.rlike(r"(?i)^tier\d+")


def describe_tier(key: Column) -> Column:
    return F.regexp_replace(key, r"^tier(\d+)$", "tier $1")


def is_top_flight(title: Column, has_premier_league: Column) -> Column:
    text = F.lower(F.coalesce(title, F.lit("")))
    return F.when(text.contains("premier league") | text.contains("football league premier division"), True).when(text.contains("first division"), ~has_premier_league).otherwise(False)


def labels_year(labels: Column) -> Column:
    """The year of an array of labels: the first four digits in a row of the first one that has some."""
    return F.get(F.filter(F.transform(labels, lambda x: F.regexp_extract(x, r"(\d{4})", 1)), lambda y: y != ""), 0).cast("int")
