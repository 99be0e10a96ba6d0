"""The folder that all executors share, for tables that plans are cut at."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Where such tables go in a local session that names no folder, as in tests.
LOCAL = "file:///tmp/checkpoints"


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder's path below spark.checkpoint.dir; in a local session that names none, below LOCAL."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(named or LOCAL).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df from a written copy, which is computed once and survives lost executors."""
    path = shared_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
