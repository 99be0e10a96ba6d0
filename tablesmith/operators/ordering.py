"""Numbers and files in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.sources.shared import written

#: Bits of monotonically_increasing_id() that count within a partition.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: list[str], name: str = "number", ranges: int | None = None) -> DataFrame:
    """df with `name`: 1 for the first row in the order of columns, and so on; a column of that name is replaced.

    Spark cuts the order into ranges by samples, tasks sort and count one range each, and the sizes of the ranges before
    it give a range its first number. The ranges are written once to the shared folder, as cuts by samples would come out
    otherwise when a lost task runs again. Only the sizes come to the driver. Nulls come first; rows that are equal in
    all columns of the order get numbers in any order; an empty table gives no rows.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != name]).alias("row"), *[F.col(f"`{c}`").alias(f"by{k}") for k, c in enumerate(order)])
    by = [f"by{k}" for k in range(len(order))]
    ranged = rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
    placed = written(ranged.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("place")), "numbered")
    before, total = [], 0
    for r in placed.groupBy("part").agg(F.max("place").alias("last")).orderBy("part").collect():
        before.append((r["part"], total))
        total += r["last"] + 1
    first = spark.createDataFrame(before, "part int, before long")
    return placed.join(F.broadcast(first), "part").select("row.*", (F.col("before") + F.col("place") + 1).alias(name))
