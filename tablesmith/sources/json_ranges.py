"""JSON datasets of any length, read in ranges: each task tells how its range changes depth and quoting, and sums over ranges tell where it began.

Spark's text source splits a file into records that end with a closing brace, so no record begins within an escape. A
first pass over the ranges counts, for both ways in which a range can begin (within a string or not), how the depth
changes and how many cuts there are at each depth below or above the one it begins at. Sums over the ranges before turn
these into each range's own start, and a second pass cuts out the parts of depth two: the seasons of {"seasons": {...}},
or the tiers of seasons alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts are cut out at this depth.
PART = 2
_RANGE = "start long, odd boolean, inside boolean, delta long, cuts map<long,long>, opened map<long,long>"
_RANGE_ARROW = pa.schema([("start", pa.int64()), ("odd", pa.bool_()), ("inside", pa.bool_()), ("delta", pa.int64()), ("cuts", pa.map_(pa.int64(), pa.int64())), ("opened", pa.map_(pa.int64(), pa.int64()))])
_PIECES = "cut long, root long, depth long, start long, batch long, place long, text string"
_PIECES_ARROW = pa.schema([*((name, pa.int64()) for name in ("cut", "root", "depth", "start", "batch", "place")), ("text", pa.string())])
#: A key of an object and what follows it.
_ENTRY = r'(?s)^\s*("(?:[^"\\]|\\.)*+")\s*:\s*(.*?)\s*$'
_STRING = re.compile(r'"(?:[^"\\]|\\.)*+("?)', re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*+"', re.S)


class Begin(NamedTuple):
    """Where a range begins: within a string, at which depth, behind how many cuts and how many parts' openings."""

    inside: bool
    depth: int
    cuts: int
    roots: int


class Marks(NamedTuple):
    """Of a stretch of text: offsets of its structural bytes, the depth that each leads to, whether it opens or closes; and how the stretch ends."""

    at: np.ndarray
    depth: np.ndarray
    step: np.ndarray
    inside: bool
    end: int

    @property
    def level(self) -> np.ndarray:
        """The depth of the part that a mark ends or begins: that behind an opening one, that before a closing one."""
        return self.depth + (self.step < 0)


def marks(data: np.ndarray, inside: bool, depth: int) -> Marks:
    """Brackets and commas outside strings of bytes that begin within a string or not, at a depth."""
    place = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != 0x5C, place, -1))  # the last byte that is no backslash
    before = np.concatenate([[-1], other[:-1]]) if len(data) else other
    quotes = (data == 0x22) & ((place - 1 - before) % 2 == 0)
    quoted = (np.cumsum(quotes) + inside) % 2 == 1
    step = np.zeros(len(data), np.int8)
    step[(data == 0x7B) | (data == 0x5B)] = 1
    step[(data == 0x7D) | (data == 0x5D)] = -1
    found = ((step != 0) | (data == 0x2C)) & ~quoted
    at = np.flatnonzero(found)
    steps = step[at].astype(np.int64)
    return Marks(at, depth + np.cumsum(steps), steps, bool(quoted[-1]) if len(data) else inside, depth + int(steps.sum()))


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All records of a batch as bytes, each with its brace again; where each begins, and each one's range."""
    values = batch["value"].to_pylist()
    joined = "}".join([*values, ""]).encode() if values else b""
    return np.frombuffer(joined, np.uint8), batch["start"].to_numpy(zero_copy_only=False), np.cumsum([0, *(len(v.encode()) + 1 for v in values)])


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(range, bytes) of the records of each range in a batch."""
    data, starts, ends = _texts(batch)
    if len(starts):
        first = np.flatnonzero(np.concatenate([[True], starts[1:] != starts[:-1]]))
        for a, b in zip(first, [*first[1:], len(starts)], strict=True):
            yield int(starts[a]), data[ends[a] : ends[b]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two rows a range, for a range that begins outside a string and inside one."""
    now: int | None = None
    state: list[dict] = []

    def rows() -> pa.RecordBatch:
        made = [{**s, "cuts": list(s["cuts"].items()), "opened": list(s["opened"].items())} for s in state]
        return pa.RecordBatch.from_pylist(made, schema=_RANGE_ARROW)

    for batch in batches:
        for start, data in _stretches(batch):
            if start != now:
                if state:
                    yield rows()
                now = start
                state = [{"start": start, "inside": inside, "odd": inside, "delta": 0, "cuts": {}, "opened": {}} for inside in (False, True)]
            for s in state:
                found = marks(data, s["odd"], s["delta"])
                for name, levels in (("cuts", found.level), ("opened", found.depth[found.step > 0])):
                    for level, n in zip(*np.unique(levels, return_counts=True), strict=True):
                        s[name][int(level)] = s[name].get(int(level), 0) + int(n)
                s["odd"], s["delta"] = found.inside, found.end
    if state:
        yield rows()


def begins(records: DataFrame) -> tuple[dict[int, Begin], bool]:
    """The Begin of each range of a file's records(start, value), and whether the file closes all that it opens.

    What a range does to either way of beginning is composed over the ranges in order. It is two rows for each range,
    so the driver, which lists the ranges anyway, gets a few numbers for each of them.
    """
    does = {(r["start"], r["inside"]): r for r in records.mapInArrow(_counted, _RANGE).collect()}
    out: dict[int, Begin] = {}
    now = Begin(False, 0, 0, 0)
    for start in sorted({start for start, _ in does}):
        out[start] = now
        r = does[start, now.inside]
        cuts = sum(n for level, n in r["cuts"].items() if level + now.depth <= PART)
        now = Begin(r["odd"], now.depth + r["delta"], now.cuts + cuts, now.roots + r["opened"].get(PART - now.depth, 0))
    return out, now.depth in (0, -1) and not now.inside  # the reader drops the last brace, or adds one behind the end


def pieces(records: DataFrame, begin: dict[int, Begin]) -> DataFrame:
    """Pieces of the parts at depth one and PART: their place among all cuts and texts; a part may lie in many pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        at = Begin(False, 0, 0, 0)
        for number, batch in enumerate(batches):
            out = []
            for start, data in _stretches(batch):
                if start != now:
                    now, at = start, begin[start]
                found = marks(data, at.inside, at.depth)
                ending = found.level <= PART
                ends, steps, after = found.at[ending], found.step[ending], found.depth[ending]
                borders = [-1, *ends.tolist(), len(data)]
                depth, roots = at.depth, at.roots
                for k, (a, b) in enumerate(zip(borders, borders[1:], strict=False)):
                    if 0 < depth and b > a + 1:
                        out.append({"cut": at.cuts + k, "root": roots, "depth": min(depth, PART), "start": start, "batch": number, "place": k, "text": data[a + 1 : b].tobytes().decode()})
                    if k < len(ends):
                        depth = int(after[k])
                        roots += int(steps[k] > 0 and depth == PART)
                at = Begin(found.inside, found.end, at.cuts + len(ends), roots)
            yield pa.RecordBatch.from_pylist(out, schema=_PIECES_ARROW)

    return records.mapInArrow(cut, _PIECES)


def records_of(spark: SparkSession, path: str) -> DataFrame:
    """(start, value): records of a file, in order within the range that begins at start."""
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_block_start").alias("start"), "value")


def stripped(spark: SparkSession, path: str) -> DataFrame:
    """(value) in order: the records of a JSON object's file without white space outside strings; a closing brace belongs behind each.

    A file that is no whole object is an error.
    """
    records = records_of(spark, path)
    begin, whole = begins(records)
    if not whole or not begin:
        raise ValueError(f"no whole JSON object: {path}")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        inside, number = False, 0
        for batch in batches:
            out: list[list] = [[], [], []]
            for start, value in zip(batch["start"].to_pylist(), batch["value"].to_pylist(), strict=True):
                if start != now:
                    now, inside, number = start, begin[start].inside, 0
                parts, inside = without_space(value, inside)
                number += 1
                for column, x in zip(out, (start, number, parts), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["start", "number", "value"])

    made = records.mapInArrow(strip, "start long, number long, value string")
    if not _ends_with_brace(spark, path):  # what follows the last brace is no record
        last = made.filter(F.col("start") == max(begin)).orderBy(F.desc("number")).first()
        if last["value"]:
            raise ValueError(f"no whole JSON object: {path}")
        made = made.filter((F.col("start") != last["start"]) | (F.col("number") != last["number"]))
    return made.orderBy("start", "number").select("value")


def without_space(value: str, inside: bool) -> tuple[str, bool]:
    """A text that begins within a string or not, without white space outside strings; and whether it ends within one."""
    out, at = [], 0
    if inside:
        m = _STRING_END.match(value)
        if m is None:
            return value, True
        out.append(m[0])
        at = m.end()
    for m in _STRING.finditer(value, at):
        out += ["".join(value[at : m.start()].split()), m[0]]
        at = m.end()
        if not m[1]:
            return "".join(out), True
    return "".join([*out, "".join(value[at:].split())]), False


def _ends_with_brace(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    file = system.open(at)
    try:
        file.seek(system.getFileStatus(at).getLen() - 1)
        return file.read() == ord("}")
    finally:
        file.close()


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Raw tiers (without source_rank) of a JSON file, as raw_tiers() gives them; season_ord and tier_ord keep the order but skip numbers.

    A file that is no whole JSON object gives no rows. Only one season of {"seasons": ...}, or one tier, is a value of its
    own; the file itself is never one.
    """
    records = records_of(spark, path)
    begin, whole = begins(records)
    if not whole:
        begin = {}
        records = records.limit(0)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "batch", "place", "text"))), lambda p: p["text"]), "")
    parts = pieces(records, begin).groupBy("cut", "root", "depth").agg(joined.alias("text"))
    key = F.regexp_extract("text", _ENTRY, 1)
    names = parts.filter("depth = 1").select(F.col("root"), F.get(F.from_json(F.concat(F.lit("["), key, F.lit("]")), "array<string>"), 0).alias("name"), F.regexp_extract("text", _ENTRY, 2).alias("value")).filter("name is not null")
    opening = names.filter("value = ''").select((F.col("root") + 1).alias("root"), F.col("name").alias("root_name"))
    held = names.filter("name = 'seasons' and value <> 'null'").select(F.lit(True).alias("wrapped")).limit(1)
    entries = parts.filter("depth = 2").join(opening, "root").join(F.broadcast(held), how="left")
    whole_part = F.concat(F.lit("{"), "text", F.lit("}"))
    seasons = entries.filter("wrapped and root_name = 'seasons'").select(F.col("cut").cast("int").alias("season_ord"), F.explode(F.map_entries(F.from_json(whole_part, "map<string, map<string, string>>"))).alias("s"))
    of_seasons = seasons.select(F.col("s.key").alias("season_key"), "season_ord", F.posexplode(F.map_entries("s.value")).alias("tier_ord", "t"))
    alone = entries.filter("wrapped is null").select(
        F.col("root_name").alias("season_key"), F.col("root").cast("int").alias("season_ord"), F.col("cut").cast("int").alias("tier_ord"), F.explode(F.map_entries(F.from_json(whole_part, "map<string, string>"))).alias("t")
    )
    return of_seasons.unionByName(alone).select("season_key", "season_ord", F.col("t.key").alias("tier_key"), "tier_ord", F.col("t.value").alias("tier_json"))
