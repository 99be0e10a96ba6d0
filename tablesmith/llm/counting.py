"""Counting of 64-bit keys without a row a key: sorted blocks of keys travel through the shuffle as binary values."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablesmith.llm.common import small

U = np.uint64
#: Distinct keys that a map task holds before it hands them on.
HELD = 1 << 22


def planes(a: np.ndarray) -> bytes:
    """Bytes of an array by significance, which lets the shuffle's compression squeeze small values."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def from_planes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return planes(np.diff(keys, prepend=U(0)))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(raw, U), dtype=U)


def total(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts' sums."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def ranges(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The ranges, of 2**bits, that sorted keys lie in, and where in them."""
    if len(keys):
        part = keys >> U(64 - bits)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
            yield int(part[a]), slice(a, b)


class Tally:
    """Counts of keys under a tag; hands on sorted blocks for each of 2**bits ranges of keys."""

    def __init__(self, bits: int):
        self.bits = bits
        self.parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, tag: str, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if len(keys):
            keys, counts = total(keys, np.ones(len(keys), np.int64) if counts is None else counts)
            self.parts.setdefault(tag, []).append((keys, counts))
            self.size += len(keys)

    def squeeze(self) -> None:
        self.parts = {t: [total(np.concatenate([k for k, _ in p]), np.concatenate([c for _, c in p]))] for t, p in self.parts.items()}
        self.size = sum(len(p[0][0]) for p in self.parts.values())

    def full(self) -> bool:
        if self.size > 2 * HELD:
            self.squeeze()
        return self.size > HELD

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """One row for each range that has keys: the tags' sorted blocks of that range."""
        self.squeeze()
        rows: dict[int, list[tuple[str, bytes, bytes]]] = {}
        for tag, [(keys, counts)] in self.parts.items():
            for i, cut in ranges(keys, self.bits):
                rows.setdefault(i, []).append((tag, pack_keys(keys[cut]), planes(counts[cut])))
        some = sorted(rows)
        columns = [[[x[k] for x in rows[i]] for i in some] for k in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(c, f.type) for c, f in zip(columns, list(BLOCK_SCHEMA)[1:]))], schema=BLOCK_SCHEMA)
        self.parts, self.size = {}, 0


BLOCKS = "part int, tags array<string>, keys array<binary>, counts array<binary>"
BLOCK_SCHEMA = pa.schema([("part", pa.int32()), ("tags", pa.list_(pa.string())), ("keys", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary()))])


def tally(fill: Callable[[pa.RecordBatch, Tally], None], bits: int):
    """A mapInArrow function: fill(batch, tally) adds to a task's tally, whose blocks it returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Tally(bits)
        for batch in small(batches):
            fill(batch, held)
            if held.full():
                yield from held.blocks()
        yield from held.blocks()

    return run


def resplit(bits: int):
    """A mapInArrow function: blocks as blocks for 2**bits ranges, those of one range that a task has put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Tally(bits)
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("tags", "keys", "counts")), strict=True):
                for tag, keys, counts in zip(*row, strict=True):
                    held.add(tag, unpack_keys(keys), from_planes(counts, np.int64))
                if held.full():
                    yield from held.blocks()
        yield from held.blocks()

    return run


#: Bits of ranges that a task hands on to at once: a block for each of 2**FAN ranges and each time that its memory is full.
FAN = 10


def levels(bits: int) -> list[int]:
    """Ranges that blocks are dealt to one shuffle after another, so that their number grows with the data and not with its square."""
    return [*range(FAN, bits, FAN), bits]


def dealt(blocks: DataFrame, bits: int, split: Callable, schema: str) -> DataFrame:
    """Blocks for levels(bits)[0] ranges as blocks for 2**bits, by way of the other levels."""
    for level in levels(bits)[1:]:
        blocks = blocks.repartition("part").mapInArrow(split(level), schema)
    return blocks


def merged(table: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The sorted keys and counts of all blocks of one range, by tag."""
    out: dict[str, list] = {}
    for row in zip(*(table.column(c).to_pylist() for c in ("tags", "keys", "counts"))):
        for tag, keys, counts in zip(*row):
            out.setdefault(tag, []).append((unpack_keys(keys), from_planes(counts, np.int64)))
    return {t: total(np.concatenate([k for k, _ in p]), np.concatenate([c for _, c in p])) for t, p in out.items()}


#: Bytes of a table for which one more range of keys is made; what a range then holds fits a worker some times over.
RANGE_BYTES = 1 << 26


def range_bits(docs: DataFrame, least: int = 4, most: int = 24) -> int:
    """Ranges of keys, as a power of two: two for each shuffle partition, or one for RANGE_BYTES if the table asks for more.

    The table's size is Spark's own estimate, from the files' sizes; it is passed over where Spark has none.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    by_size = size // RANGE_BYTES if size < 1 << 60 else 0
    return min(most, max(least, (2 * partitions - 1).bit_length(), by_size.bit_length()))
