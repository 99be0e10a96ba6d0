"""Datasets of seasons from JSON files or literals, and lists of files."""

from __future__ import annotations

import glob
import os
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.operators.dataset import Dataset, normalise, raw_tiers
from tablesmith.sources.json_ranges import read_ranges


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _split_bytes(spark: SparkSession) -> int:
    """The length of a file that Spark would read in one task."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def length(spark: SparkSession, path: str) -> int:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def raw_dataset(spark: SparkSession, paths: str | list[str], missing: str = "empty") -> DataFrame:
    """Raw tiers of JSON files as they are, source_rank being a file's place. A missing file is empty, or an error.

    Files that one task would read anyway are read as a whole, longer ones in ranges.
    """
    small, large = [], []
    for rank, path in enumerate([paths] if isinstance(paths, str) else paths):
        if exists(spark, path):
            (small if length(spark, path) <= _split_bytes(spark) else large).append((rank, path))
        elif missing == "error":
            raise FileNotFoundError(f"Input file not found: {path}")
    texts = spark.createDataFrame([], "source_rank int, value string")
    for rank, path in small:
        texts = texts.unionByName(spark.read.text(path, wholetext=True).select(F.lit(rank).alias("source_rank"), "value"))
    raw = raw_tiers(texts)
    for rank, path in large:
        raw = raw.unionByName(read_ranges(spark, path).withColumn("source_rank", F.lit(rank)))
    return raw


def raw_literal(spark: SparkSession, *texts: str) -> DataFrame:
    """Raw tiers of JSON texts."""
    return raw_tiers(spark.createDataFrame(list(enumerate(texts)), "source_rank int, value string"))


def load(spark: SparkSession, path: str, missing: str = "empty", compat: bool = True) -> Dataset:
    return normalise(raw_dataset(spark, path, missing), compat)


def from_literal(spark: SparkSession, text: str) -> Dataset:
    return normalise(raw_literal(spark, text))


def expand_targets(targets: list[str], spark: SparkSession | None = None) -> list[str]:
    """JSON files of targets: files, globs, and folders one level deep; each once, sorted; missing ones with a warning.

    With a session, targets of any of its file systems; those of other ones than this machine's need one.
    """
    found = set()
    for target in targets:
        if "://" in target and spark is not None:
            found.update(_remote(spark, target))
            continue
        for path in glob.glob(target) or [target]:
            if os.path.isdir(path):
                found.update(os.path.realpath(e.path) for e in os.scandir(path) if e.is_file() and e.name.lower().endswith(".json"))
            elif os.path.isfile(path):
                found.add(os.path.realpath(path))
            else:
                warnings.warn(f"no such file or folder: {path}", stacklevel=2)
    return sorted(found)


def _remote(spark: SparkSession, target: str) -> set[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(target)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = set()
    for status in system.globStatus(at) or []:
        inner = [f for f in system.listStatus(status.getPath()) if f.getPath().getName().lower().endswith(".json")] if status.isDirectory() else [status]
        found.update(f.getPath().toString() for f in inner if f.isFile())
    if not found:
        warnings.warn(f"no such file or folder: {target}", stacklevel=3)
    return found
