"""An extension: upserts of seasons from a stream of raw tiers, season by season, into a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tablesmith.operators.dataset import KEY, RAW, normalise


def upsert_stream(raw: DataFrame, path: str, checkpoint: str, compat: bool = True) -> StreamingQuery:
    """Write each batch's seasons of raw (columns RAW) as Parquet partitions by season, replacing those that it has.

    A season must come whole in a batch, as a later one replaces it. Batches that run again write the same partitions.
    """
    def write(batch: DataFrame, _: int) -> None:
        data = normalise(batch, compat)
        whole = data.tiers.drop("extra").join(data.entries.drop("bad_fields"), KEY, "left")
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("season_key").parquet(path)

    names = [c.split()[0] for c in RAW.split(", ")]
    return raw.select(*names).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
