"""Match results from CSV files with a header, all columns read as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.functions.js import js_parse_int


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of CSV files (a path, a glob, or several), with `file` and `row_ord`, which grows along each file."""
    rows = spark.read.csv(path, header=True, inferSchema=False)
    return rows.select("*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("row_ord"))


def as_matches(rows: DataFrame, tier: int | None = None) -> DataFrame:
    """matches of rows(Season, home, visitor, hgoal, vgoal, result, row_ord, and tier unless given).

    Goals and seasons are the whole numbers that their texts begin with; blank goals are null. Rows without a season fall away.
    """
    number = lambda c: js_parse_int(F.col(c)).cast("int")
    return rows.select(
        number("Season").alias("season"), (F.lit(tier) if tier is not None else number("tier")).cast("int").alias("tier"), F.col("row_ord").alias("match_ord"),
        "home", "visitor", number("hgoal").alias("hgoal"), number("vgoal").alias("vgoal"), "result",
    ).filter("season is not null")
