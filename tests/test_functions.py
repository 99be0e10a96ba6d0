import pytest
from pyspark.sql import functions as F

from tablesmith.functions import js, league

NUMBERS = [("", 0.0), (" ", 0.0), (" 7﻿", 7.0), ("1e3", 1000.0), ("0x10", 16.0), ("0b11", 3.0), ("1f", None), ("NaN", None), ("1d", None), ("-.5", -0.5), ("5.", 5.0), ("Infinity", float("inf")), ("1_0", None), (None, None)]


def values(spark, texts, column):
    return [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, v string").orderBy("k").select(column(F.col("v"))).collect()]


def test_numbers(spark):
    assert values(spark, [t for t, _ in NUMBERS], js.js_number) == [n for _, n in NUMBERS]
    assert values(spark, ["1888-89", " 12x", "abc", "-3", "", None], js.js_parse_int) == [1888, 12, None, -3, None, None]
    assert values(spark, ["3.5.1", "x", "+2e2z", ".5"], js.js_parse_float) == [3.5, None, 200.0, 0.5]
    assert values(spark, ["−5[1]", "1,234", "abc", "–3"], lambda c: league.cell_number(c, True)) == [-51.0, 1234.0, None, -3.0]
    assert values(spark, ["−5"], lambda c: league.cell_number(c, False)) == [5.0]
    assert values(spark, [None, "", "x", "4"], league.required_number) == [0.0, 0.0, None, 4.0] and values(spark, [None, "", "4"], league.optional_number) == [None, None, 4.0]


def test_names_and_notes(spark):
    assert values(spark, ["  Pos. ", "Games  Played", "Promotion or relegation", "Other"], league.header_field) == ["pos", "played", "notes", "other"]
    assert values(spark, ["ASTON VILLA", "é"], league.title_case) == ["Aston villa", "É"]
    assert values(spark, ["reprived from re-election", "reprieved from re-election", None], league.noted_reprieved) == [True, False, False]
    assert values(spark, ["reprieved from re-election"], lambda c: league.noted_reprieved(c, compat=False)) == [True]
    assert values(spark, ["text/html; charset=UTF-8 ", "x"], league.encoding_of) == ["utf-8", None]
    assert values(spark, ["2008–09_in", "abc", "", None], league.slug_season_key) == ["2008", "abc", "unknown-season", "unknown-season"]
    assert values(spark, ["tier1", "Tier2x", "tierx", "info"], lambda c: F.concat_ws(",", league.is_tier(c).cast("string"), league.is_numbered_tier(c).cast("string"), league.begins_with_numbered_tier(c).cast("string"))) == ["true,true,true", "true,false,true", "true,false,false", "false,false,false"]
    assert values(spark, ["Yes", " 1", "no", None], league.truthy) == [True, True, False, False]
    assert values(spark, ["Northern Premier League", "First Division"], lambda c: league.is_top_flight(c, F.lit(True))) == [True, False]


@pytest.mark.parametrize("season, down, up", [(1890, 0, 0), (1897, 0, 0), (1898, 2, 2), (1980, 2, 2), (1981, 3, 3), (1991, 3, 3), (1995, 4, 2), (2000, 3, 3)])
def test_movement_rules(spark, season, down, up):
    row = spark.range(1).select(league.relegated_count(F.lit(season)).alias("d"), league.promoted_count(F.lit(season)).alias("u")).first()
    assert (row["d"], row["u"]) == (down, up)


def test_war_spans_differ(spark):
    rows = spark.range(1914, 1948).select("id", league.war_season_of_merge(F.col("id")).alias("m"), league.war_season_of_fetch(F.col("id")).alias("f")).collect()
    assert {r["id"] for r in rows if r["f"] and not r["m"]} == {1919, 1946}
