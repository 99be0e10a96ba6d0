"""Shared plumbing: reading tables, stashing intermediate tables, and Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The word separators of every operator here: space, tab, LF, VT, FF and CR.
SPACES = "\t\n\x0b\x0c\r "
#: Rows that a worker looks at together.
PART_ROWS = 512
#: Where tables are stashed when a local session names no checkpoint folder, as in tests.
DEFAULT_STASH = "/tmp/checkpoints"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir; in a local session that names none, the test folder."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (named or f"file://{DEFAULT_STASH}").rstrip("/")


class Stash:
    """Tables written once into the shared checkpoint folder, which cuts lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.base = f"{stash_dir(spark)}/{tag}-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: set[str] = set()

    def __call__(self, df: DataFrame, plain: bool = False) -> DataFrame:
        """df from its written copy; plain: neither dictionaries nor compression, for columns of hashes."""
        self.count += 1
        path = f"{self.base}/{self.count}"
        writer = df.write.option("compression", "none").option("parquet.enable.dictionary", "false") if plain else df.write
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stash_path = path
        self.paths.add(path)
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a stashed table that no later plan reads."""
        self._delete(df.stash_path)

    def keep_only(self, *needed: DataFrame) -> None:
        """Delete all stashed tables but those that later plans read."""
        for path in self.paths - {df.stash_path for df in needed}:
            self._delete(path)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.paths.discard(name)


def text_of(column: str = "text"):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of PART_ROWS rows, empty ones left out, so that what is made of a part stays small.

    Spark bounds batches by spark.sql.execution.arrow.maxBytesPerBatch, 64 MB unless the session says otherwise, so that
    texts of any length reach a worker few at a time.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(start, PART_ROWS)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str | StructType) -> DataFrame:
    """Apply fn to small Arrow batches; fn returns {column: Arrow array or list} in the schema's order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out = fn(batch)
            arrays = [a.cast(f.type) if isinstance(a := out[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(a, f.type) for f in target]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)
