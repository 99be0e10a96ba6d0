"""Merging of ranked sources: the first with data wins by tier, or the last by season."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.league import is_tier, season_number, war_season_of_merge
from tablesmith.operators.dataset import KEY, Dataset, has_data


def union(datasets: list[Dataset]) -> Dataset:
    """All blocks of datasets, source_rank being their place in the list."""
    ranked = [[part.withColumn("source_rank", F.lit(k)) for part in (d.tiers, d.entries)] for k, d in enumerate(datasets)]
    return Dataset(*(reduce(DataFrame.unionByName, parts) for parts in zip(*ranked)))


def _first(data: Column):
    """A tier's sources in the order in which they count: those with data first."""
    return Window.partitionBy("season_key", "tier_key").orderBy((data & is_tier(F.col("tier_key"))).desc(), "source_rank")


def first_wins(sources: DataFrame, include_empty: bool = False) -> DataFrame:
    """(season_key, tier_key, source_rank) that stays of sources(season_key, tier_key, source_rank, data).

    Tiers: the first source with data, else the first. With include_empty a later empty tier takes the place of an
    earlier one, data or not, which makes the order of sources matter at each step. Other blocks: the first source.
    """
    if not include_empty:
        return sources.withColumn("place", F.row_number().over(_first(F.col("data")))).filter("place = 1").select("season_key", "tier_key", "source_rank")
    # A fold over the sources in order ends with the first that has data behind the last empty one, else with that, else with the first.
    last_empty = F.max(F.when(~F.col("data"), F.col("source_rank"))).over(Window.partitionBy("season_key", "tier_key"))
    behind = F.col("data") & (F.col("empty").isNull() | (F.col("source_rank") > F.col("empty")))
    folded = sources.select("season_key", "tier_key", "source_rank", "data", last_empty.alias("empty")).groupBy("season_key", "tier_key").agg(F.min("source_rank").alias("first"), F.max("empty").alias("empty"), F.min(F.when(behind, F.col("source_rank"))).alias("behind"))
    return folded.select("season_key", "tier_key", F.when(is_tier(F.col("tier_key")), F.coalesce("behind", "empty", "first")).otherwise(F.col("first")).alias("source_rank"))


def last_wins(sources: DataFrame) -> DataFrame:
    """(season_key, source_rank): the last source that has each season of sources(season_key, source_rank)."""
    return sources.groupBy("season_key").agg(F.max("source_rank").alias("source_rank"))


def combine(datasets: list[Dataset], include_empty: bool = False) -> tuple[Dataset, DataFrame]:
    """The merged dataset without war seasons and (unless include_empty) seasons without data, and a row of figures.

    A season that only one source has comes from it whole. Figures: merged_seasons, inputs, excluded, input_seasons,
    removed_war_seasons, missing_seasons (numbers) and missing_keys (those that are no numbers) of excluded seasons.
    """
    return combine_ranked(union(datasets), len(datasets), include_empty)


def combine_ranked(whole: Dataset, inputs: int, include_empty: bool = False) -> tuple[Dataset, DataFrame]:
    """combine() of datasets that are one already, told apart by their source_rank; inputs is their number."""
    if include_empty:
        tiers = whole.tiers.join(first_wins(whole.tiers.select("season_key", "tier_key", "source_rank", has_data().alias("data")), True), KEY, "left_semi")
    else:  # the first one of an order that tiers are put in anyway, so without a join
        tiers = whole.tiers.withColumn("__place", F.row_number().over(_first(has_data()))).filter("__place = 1").drop("__place")
    seasons = tiers.groupBy("season_key").agg(F.bool_or(has_data()).alias("data"))
    judged = seasons.select("season_key", "data", season_number(F.col("season_key")).alias("number"))
    judged = judged.withColumn("war", war_season_of_merge(F.col("number"))).withColumn("kept", ~F.col("war") & (F.col("data") | F.lit(include_empty)))
    keep = judged.filter("kept").select("season_key")
    kept = tiers.join(keep, "season_key", "left_semi")
    data = Dataset(kept, whole.entries.join(kept.select(*KEY), KEY, "left_semi"))
    excluded = ~F.col("kept") & ~F.col("war")
    held = whole.tiers.select("source_rank", "season_key").distinct().agg(F.count("*").alias("input_seasons"))
    figures = judged.agg(
        F.count_if("kept").alias("merged_seasons"), F.lit(inputs).cast("long").alias("inputs"), F.count_if(excluded).alias("excluded"), F.count_if("war").alias("removed_war_seasons"),
        F.array_sort(F.collect_list(F.when(excluded, F.col("number")))).alias("missing_seasons"),
        F.array_sort(F.collect_list(F.when(excluded & F.col("number").isNull(), F.col("season_key")))).alias("missing_keys"),
    )
    return data, figures.crossJoin(held)


def overwrite(datasets: list[Dataset]) -> Dataset:
    """The merged dataset in which a season comes whole from the last source that has it."""
    whole = union(datasets)
    chosen = last_wins(whole.tiers.select("season_key", "source_rank"))
    return Dataset(*(part.join(chosen, ["season_key", "source_rank"], "left_semi").select(part.columns) for part in (whole.tiers, whole.entries)))


def missing_by_war(figures: DataFrame) -> DataFrame:
    """(bucket, seasons): the missing seasons of figures by first war, second war, and other."""
    season = F.col("season")
    bucket = F.when(season.between(1915, 1918), "ww1").when(season.between(1940, 1945), "ww2").otherwise("other")
    return figures.select(F.explode("missing_seasons").alias("season")).groupBy(bucket.alias("bucket")).agg(F.array_sort(F.collect_list("season")).alias("seasons"))
