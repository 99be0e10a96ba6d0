"""One file out of many tasks: each writes its rows as a fragment, the lengths before it give its place, and whole files take their name at the end."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes that are copied at a time.
BUFFER = 1 << 20


class Folder:
    """The file system of a path, and the few things that publishing needs of it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark._jvm
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.configuration = spark._jsc.hadoopConfiguration()
        at = self.hadoop.Path(path)
        self.system = at.getFileSystem(self.configuration)
        self.target = self.system.makeQualified(at)
        self.local = self.system.getUri().getScheme() == "file"

    def path(self, text: str):
        return self.hadoop.Path(text)

    def fragments(self, folder: str) -> list[tuple[str, int]]:
        """Paths and lengths of a written folder's fragments, in the order of the tasks that wrote them."""
        files = [(f.getPath().toString(), f.getLen()) for f in self.system.listStatus(self.path(folder))]
        return sorted((p, n) for p, n in files if n and os.path.basename(p).startswith("part-"))

    def write(self, path: str, data: bytes) -> None:
        out = self.system.create(self.path(path), True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def delete(self, path: str) -> None:
        self.system.delete(self.path(path), True)


def local_name(path: str) -> str:
    return unquote(urlparse(path).path)


def publish(lines: DataFrame, path: str, end: str, head: str = "", tail: str = "") -> None:
    """Write head, the texts of lines (one column, in its order, `end` behind each) and tail as one file, on any file system that Spark knows.

    Tasks write fragments beside path. On a local or mounted file system tasks copy them to their places in the file; on
    one that can join files these are joined; elsewhere they are copied one after another by the driver's JVM, a buffer
    at a time. Only paths and lengths come to the driver. What is at path is replaced when all is written, and stays as
    it is if anything fails.
    """
    spark = lines.sparkSession
    folder = Folder(spark, path)
    target = folder.target.toString()
    work = f"{target}.{uuid.uuid4().hex}.parts"
    try:
        lines.write.option("lineSep", end).text(f"{work}/lines")
        fragments = folder.fragments(f"{work}/lines")
        whole = f"{work}/whole"
        (_place if folder.local else _join)(folder, fragments, whole, head.encode(), tail.encode())
        _replace(folder, whole, target)
    finally:
        folder.delete(work)


def _replace(folder: Folder, whole: str, target: str) -> None:
    if folder.local:
        os.replace(local_name(whole), local_name(target))
        base, name = os.path.split(target)
        folder.delete(f"{base}/.{name}.crc")  # that of an earlier file
        return
    folder.delete(target)
    if not folder.system.rename(folder.path(whole), folder.path(target)):
        raise OSError(f"could not move {whole} to {target}")


def _place(folder: Folder, fragments: list[tuple[str, int]], whole: str, head: bytes, tail: bytes) -> None:
    """Copy fragments to their places in a file, each in a task."""
    name, at, places = local_name(whole), len(head), []
    for path, size in fragments:
        places.append((local_name(path), at))
        at += size
    with open(name, "wb") as out:
        out.write(head)
        out.seek(at)
        out.write(tail)
        out.truncate(at + len(tail))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, place in zip(batch["path"].to_pylist(), batch["place"].to_pylist(), strict=True):
                with open(path, "rb") as source, open(name, "r+b") as out:
                    out.seek(place)
                    shutil.copyfileobj(source, out, BUFFER)
            yield batch.select(["place"])

    if places:
        spread = folder.spark.createDataFrame(places, "path string, place long").repartition(len(places))
        spread.mapInArrow(copy, "place long").write.format("noop").mode("overwrite").save()


def _join(folder: Folder, fragments: list[tuple[str, int]], whole: str, head: bytes, tail: bytes) -> None:
    folder.write(whole, head)
    folder.write(f"{whole}.tail", tail)
    paths = [folder.path(p) for p, _ in fragments] + [folder.path(f"{whole}.tail")]
    try:
        listed = folder.spark.sparkContext._gateway.new_array(folder.hadoop.Path, len(paths))
        for k, p in enumerate(paths):
            listed[k] = p
        folder.system.concat(folder.path(whole), listed)
    except Exception as e:  # which class it is depends on the file system
        if "UnsupportedOperation" not in f"{type(e).__name__} {e}":
            raise
        out = folder.system.create(folder.path(whole), True)
        try:
            out.write(bytearray(head))
            for p in paths:
                source = folder.system.open(p)
                try:
                    folder.jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, BUFFER, False)
                finally:
                    source.close()
        finally:
            out.close()
