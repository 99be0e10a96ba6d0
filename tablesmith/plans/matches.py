"""Match results derived from the orders table, for queries over the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COLUMNS = """
  cast(year(o_orderdate) - 26 * (o_orderkey % 4) as int) as season, cast(1 + floor(o_orderkey / 4) % 2 as int) as tier,
  cast(o_orderkey as bigint) as match_ord,
  concat('team', lpad(cast(o_custkey % 20 as varchar(9)), 2, '0')) as home,
  concat('team', lpad(cast((o_custkey + 1 + o_orderkey % 19) % 20 as varchar(9)), 2, '0')) as visitor,
  cast(o_orderkey % 5 as int) as hgoal, cast((o_orderkey + o_custkey) % 4 as int) as vgoal,
  case when o_orderkey % 5 > (o_orderkey + o_custkey) % 4 then 'H' when o_orderkey % 5 < (o_orderkey + o_custkey) % 4 then 'A' else 'D' end as result
"""
SQL = f"select {COLUMNS} from orders"


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(*[c.strip() for c in _split(COLUMNS)])


def _split(text: str) -> list[str]:
    parts, depth, now = [], 0, ""
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            parts.append(now)
            now = ""
        else:
            now += c
    return [*parts, now]
