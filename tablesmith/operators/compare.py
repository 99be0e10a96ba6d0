"""Two datasets compared season by season: what one has and the other has not, and how their rows differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.sources.shared import written

TIER = ["season_key", "tier_key"]


def shared_tiers(a: DataFrame, b: DataFrame) -> DataFrame:
    """(season_key, tier_key, side) of the blocks of two datasets' tiers: both, left or right. Repeated blocks count once."""
    left, right = (t.select(*TIER).distinct().withColumn(name, F.lit(True)) for t, name in ((a, "in_a"), (b, "in_b")))
    side = F.when(F.col("in_a") & F.col("in_b"), "both").when(F.col("in_a"), "left").otherwise("right")
    return left.join(right, TIER, "full").select(*TIER, side.alias("side"))


def _sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Order-free sums of a group's rows: equal for equal rows as often, whatever their order."""
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two"))


def _different(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of which the sums differ, or that one side lacks."""
    left, right = (x.select(*keys, F.struct("n", "one", "two").alias(name)) for x, name in ((a, "left"), (b, "right")))
    return left.join(right, keys, "full").filter(~F.col("left").eqNullSafe(F.col("right"))).select(*keys)


def diff(a: DataFrame, b: DataFrame, name: str = "team", ignore: tuple[str, ...] = ("source_rank", "season_ord", "tier_ord", "row_ord")) -> DataFrame:
    """(season_key, tier_key, name, change, fields, copies): what makes entries b of entries a.

    change: added, removed, or changed where rows of the same name stand on both sides; fields: of changed rows the
    columns whose values differ, in order of name. Rows that occur several times are compared as often as they occur:
    copies counts them. Columns of `ignore` don't count; both sides need the same other columns. Null keys and names are
    values like others. Each side is computed once, into the shared folder. Sums are compared by season first, then by tier of seasons that differ, and only rows of tiers
    that differ are compared themselves.
    """
    columns = sorted(c for c in a.columns if c not in (*ignore, *TIER))
    if columns != sorted(c for c in b.columns if c not in (*ignore, *TIER)):
        raise ValueError("the datasets have different columns")
    keyed = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(c)  # noqa: E731  null as a value that joins
    plain = [F.col(f"`{c}`") for c in columns]
    hashed = lambda seed: F.xxhash64(F.lit(seed), *TIER, *plain).cast("decimal(38,0)")
    sides = [written(x.select(*[keyed(c) for c in TIER], F.struct(*plain).alias("row"), F.lit(1).cast("long").alias("n"), hashed(1).alias("one"), hashed(2).alias("two")), "compared") for x in (a, b)]
    tiers = [_sums(s, TIER) for s in sides]
    seasons = _different(*(_sums(t, TIER[:1]) for t in tiers), TIER[:1])
    changed = _different(*(t.join(seasons, TIER[:1], "left_semi") for t in tiers), TIER)
    counted = reduce(DataFrame.unionByName, (s.join(changed, TIER, "left_semi").select(*TIER, "row", F.lit(sign).alias("side")) for s, sign in zip(sides, (-1, 1), strict=True)))
    net = counted.groupBy(*TIER, "row").agg(F.sum("side").alias("net")).filter("net <> 0")
    own = F.col("row").getField(name)
    groups = net.groupBy(*TIER, own.alias(name)).agg(
        F.coalesce(-F.sum(F.when(F.col("net") < 0, F.col("net"))), F.lit(0)).alias("gone"),
        F.coalesce(F.sum(F.when(F.col("net") > 0, F.col("net"))), F.lit(0)).alias("come"),
        *[F.struct(_values(c, F.col("net") < 0).alias("before"), _values(c, F.col("net") > 0).alias("after")).alias(f"f_{c}") for c in columns],
    )
    fields = F.array_compact(F.array(*[F.when(F.col(f"f_{c}.before") != F.col(f"f_{c}.after"), F.lit(c)) for c in columns]))
    both = F.least("gone", "come")
    none = F.lit(None).cast("array<string>")
    changes = F.array(
        F.struct(F.lit("changed").alias("change"), fields.alias("fields"), both.alias("copies")),
        F.struct(F.lit("removed").alias("change"), none.alias("fields"), (F.col("gone") - both).alias("copies")),
        F.struct(F.lit("added").alias("change"), none.alias("fields"), (F.col("come") - both).alias("copies")),
    )
    back = lambda c: F.when(F.col(c) != "", F.substring(F.col(c), 2, 1 << 30)).alias(c)
    return groups.select(*[back(c) for c in TIER], name, F.explode(changes).alias("c")).select(*TIER, name, "c.*").filter("copies > 0")


def _values(column: str, when: Column) -> Column:
    """All values of one side as text, in order; null is a value of its own."""
    text = F.coalesce(F.concat(F.lit("="), F.col("row").getField(column).cast("string")), F.lit(""))
    return F.sort_array(F.collect_set(F.when(when, text)))
