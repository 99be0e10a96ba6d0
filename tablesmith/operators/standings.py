"""League tables from match results, and what follows from them: best and worst, movements, clubs, chunks of seasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.js import js_trim
from tablesmith.functions.league import by_goal_average, goal_average, points_for_win, promoted_count, relegated_count
from tablesmith.operators.ordering import numbered

def league_table(matches: DataFrame) -> DataFrame:
    """Ranked tables of matches(season, tier, match_ord, home, visitor, hgoal, vgoal, result).

    Each match counts for both sides; result (H, A or D) decides, whatever the goals are, and any other result counts as
    played. Ranks go by points, goal average or difference by the season's rule, goals for, and first appearance. Null
    goals count as none. One scan and one shuffle by table and team with sums on the map side, then one by table.
    """
    side = lambda n, team, gf, ga, win: F.struct(F.lit(n).alias("side"), F.col(team).alias("team"), F.col(gf).alias("gf"), F.col(ga).alias("ga"), F.lit(win).alias("win"))
    both = F.array(side(0, "home", "hgoal", "vgoal", "H"), side(1, "visitor", "vgoal", "hgoal", "A"))
    sides = matches.select("season", "tier", "match_ord", "result", F.explode(both).alias("s")).select("season", "tier", "match_ord", "result", "s.*")
    won, drawn = F.col("result") == F.col("win"), F.col("result") == "D"
    lost = F.col("result").isin("H", "A") & ~won
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    totals = sides.groupBy("season", "tier", "team").agg(
        F.count("*").alias("played"), count(won).alias("won"), count(drawn).alias("draw"), count(lost).alias("lost"),
        F.sum(F.coalesce("gf", F.lit(0))).cast("long").alias("goals_for"), F.sum(F.coalesce("ga", F.lit(0))).cast("long").alias("goals_against"),
        F.min(F.col("match_ord") * 2 + F.col("side")).alias("first_seen"),
    )
    scored = totals.select(
        "*",
        (F.col("won") * points_for_win(F.col("season")) + F.col("draw")).cast("long").alias("points"),
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        goal_average(F.col("goals_for"), F.col("goals_against")).alias("goal_average"),
    )
    tie = F.when(by_goal_average(F.col("season")), F.col("goal_average")).otherwise(F.col("goal_difference").cast("double"))
    rank = Window.partitionBy("season", "tier").orderBy(F.desc("points"), tie.desc(), F.desc("goals_for"), "first_seen")
    return scored.withColumn("pos", F.row_number().over(rank)).drop("first_seen")


def ends(table: DataFrame, n: int = 4) -> DataFrame:
    """The first and the last n teams of each table: (season, tier, bucket, place, team), place counted in table order.

    Teams of a table of fewer than 2 n may be in both. Other columns are ignored; an empty table gives no rows.
    """
    size = F.count("*").over(Window.partitionBy("season", "tier"))
    sized = table.select("season", "tier", "team", "pos", size.alias("size"))
    top = sized.filter(F.col("pos") <= n).select("season", "tier", F.lit("top").alias("bucket"), F.col("pos").alias("place"), "team")
    low = F.greatest(F.col("size") - n, F.lit(0))
    bottom = sized.filter(F.col("pos") > low).select("season", "tier", F.lit("bottom").alias("bucket"), (F.col("pos") - low).cast("int").alias("place"), "team")
    return top.unionByName(bottom)


def movements(table: DataFrame) -> DataFrame:
    """(team, promoted, relegated): how often each team went up from tier 2 and down from tier 1.

    The season's rule gives how many move; a table with fewer teams moves none. Seasons without a tier 1 don't count.
    Null seasons move none. Other columns are ignored; an empty table gives no rows.
    """
    down, up = relegated_count(F.col("season")), promoted_count(F.col("season"))
    size = F.count("*").over(Window.partitionBy("season", "tier"))
    sized = table.filter(F.col("tier").isin(1, 2)).select("season", "tier", "team", "pos", size.alias("size"))
    seasons = table.filter("tier = 1").select("season").distinct()
    first = sized.filter((F.col("tier") == 1) & (F.col("size") >= down) & (F.col("pos") > F.col("size") - down))
    second = sized.filter((F.col("tier") == 2) & (F.col("size") >= up) & (F.col("pos") <= up)).join(seasons, "season", "left_semi")
    moved = first.select("team", F.lit(0).alias("up"), F.lit(1).alias("down")).unionByName(second.select("team", F.lit(1).alias("up"), F.lit(0).alias("down")))
    return moved.groupBy("team").agg(F.sum("up").cast("long").alias("promoted"), F.sum("down").cast("long").alias("relegated"))


def club_ids(matches: DataFrame) -> DataFrame:
    """(id, name): all different names of home teams and visitors, trimmed and not blank, numbered in order of name.

    Null names are none; other columns are ignored, and an empty table gives no rows.
    """
    names = matches.select(F.explode(F.array("home", "visitor")).alias("name")).select(js_trim(F.col("name")).alias("name")).filter("name <> ''").distinct()
    return numbered(names, ["name"]).select(F.concat(F.lit("club_"), F.col("number").cast("string")).alias("id"), "name")


def carried(keys: list[str], order: list[str], value: str, span: str) -> Column:
    """The value that a row has from an earlier one or itself: a value with a span stands for so many rows, counted by the first column of order.

    As a cell that spans rows in a table: a later span ends an earlier one. Nulls in order come first; rows need no span.
    """
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(so_far)
    opened = F.max(F.when(F.col(span).isNotNull(), F.col(order[0]))).over(so_far)
    return F.when(F.col(order[0]) < opened + last(span), last(value))


def season_chunks(matches: DataFrame, size: int = 25) -> DataFrame:
    """(tier, season, chunk, label): chunks of `size` seasons that a tier has, named by their first and last.

    Null tiers are a tier of their own, null seasons come first. Other columns are ignored; an empty table gives no rows.
    """
    seasons = matches.select("tier", "season").distinct()
    placed = seasons.withColumn("chunk", F.expr(f"cast((dense_rank() over (partition by tier order by season) - 1) div {size} as int)"))
    chunk = Window.partitionBy("tier", "chunk")
    return placed.withColumn("label", F.concat_ws("-", F.min("season").over(chunk).cast("string"), F.max("season").over(chunk).cast("string")))
