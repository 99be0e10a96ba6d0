"""A store of seasons that a build fills as it goes on: what is saved is there whole, and what is not is not there at all."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tablesmith.operators.dataset import KEY, Dataset

_FLAGS = "was_relegated boolean, was_promoted boolean, is_expansion_team boolean, was_re_elected boolean, was_reprieved boolean"
_ROW = f"struct<row_ord:int,team:string,pos:double,played:double,won:double,drawn:double,lost:double,goals_for:double,goals_against:double,points:double,given_goal_difference:double,goal_average:double,notes:string,{_FLAGS.replace(' ', ':').replace(',:', ',')},bad_fields:array<string>,goal_difference:double>"
#: A block of a season with its rows; batch and season_key are partitions.
BLOCK = f"source_rank int, season_num int, season_ord int, tier_key string, tier_ord int, tier_kind string, tier_season int, n_rows int, promoted array<string>, relegated array<string>, listed_promoted boolean, listed_relegated boolean, extra map<string,string>, rows array<{_ROW}>, batch long, season_key string"


class SeasonStore:
    """Batches of seasons in a folder of any file system.

    A batch is written below seasons/, one folder a season, and counts from the moment when its list of seasons is moved
    below manifest/ in one step. Of a season that several batches have the latest counts, so a season is replaced whole;
    readers that began before go on reading the old one until vacuum().
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.system = self.hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.path = self.system.makeQualified(self.hadoop.Path(path)).toString()

    def _exists(self, name: str) -> bool:
        return self.system.exists(self.hadoop.Path(f"{self.path}/{name}"))

    def batches(self) -> list[int]:
        """Numbers of all batches that count, in order."""
        if not self._exists("manifest"):
            return []
        names = [f.getPath().getName() for f in self.system.listStatus(self.hadoop.Path(f"{self.path}/manifest"))]
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def save(self, data: Dataset) -> int | None:
        """Put the seasons of data into the store; the batch's number, None if data has no seasons.

        Repeated blocks of a season are kept as they are. A season must come whole: its earlier blocks go.
        """
        rows = data.entries.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct(*[c for c in data.entries.columns if c not in KEY]))).alias("rows"))
        blocks = data.tiers.join(rows, KEY, "left")
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        blocks.write.partitionBy("season_key").parquet(f"{staged}/seasons")
        seasons = self._read(f"{staged}/seasons").select("season_key").distinct()
        if seasons.isEmpty():
            self._delete(staged)
            return None
        seasons.coalesce(1).write.parquet(f"{staged}/manifest")
        self.system.mkdirs(self.hadoop.Path(f"{self.path}/seasons"))
        self.system.mkdirs(self.hadoop.Path(f"{self.path}/manifest"))
        number = max(self.batches(), default=-1) + 1
        while not self._move(f"{staged}/seasons", f"seasons/batch={number}"):  # another writer, or one that was stopped, has that number
            number += 1
        if not self._move(f"{staged}/manifest", f"manifest/batch={number}"):
            raise OSError(f"could not commit batch {number} of {self.path}")
        self._delete(staged)
        return number

    def _move(self, source: str, name: str) -> bool:
        return not self._exists(name) and self.system.rename(self.hadoop.Path(source), self.hadoop.Path(f"{self.path}/{name}"))

    def _delete(self, path: str) -> None:
        self.system.delete(self.hadoop.Path(path), True)

    def _read(self, folder: str) -> DataFrame:
        fields = _parse_datatype_string(BLOCK).fields
        return self.spark.read.schema(StructType([f for f in fields if f.name != "batch"])).parquet(folder)

    def committed(self) -> DataFrame:
        """(season_key, batch): the batch that counts for each season."""
        if not self.batches():
            return self.spark.createDataFrame([], "season_key string, batch long")
        lists = self.spark.read.schema("season_key string, batch long").parquet(f"{self.path}/manifest")
        return lists.groupBy("season_key").agg(F.max("batch").alias("batch"))

    def load(self) -> Dataset:
        """All seasons in the store."""
        if self.batches():
            blocks = self.spark.read.schema(BLOCK).parquet(f"{self.path}/seasons").join(self.committed(), ["season_key", "batch"], "left_semi")
        else:
            blocks = self.spark.createDataFrame([], BLOCK)
        tiers = blocks.select("source_rank", "season_key", *[c for c in blocks.columns if c not in ("source_rank", "season_key", "rows", "batch")])
        return Dataset(tiers, blocks.select(*KEY, F.explode("rows").alias("r")).select(*KEY, "r.*"))

    def vacuum(self) -> list[int]:
        """Delete batches of which no season counts any more, and what stopped writers left; the numbers of the batches that stay."""
        used = {r["batch"] for r in self.committed().select("batch").distinct().collect()}
        self._delete(f"{self.path}/staged")
        for folder in ("manifest", "seasons"):
            if self._exists(folder):
                for f in self.system.listStatus(self.hadoop.Path(f"{self.path}/{folder}")):
                    name = f.getPath().getName()
                    if name.startswith("batch=") and int(name.removeprefix("batch=")) not in used:
                        self._delete(f"{self.path}/{folder}/{name}")
        return sorted(used)

    def clear(self) -> None:
        self._delete(self.path)
