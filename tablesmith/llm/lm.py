"""An interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays, memory-mapped."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from hashlib import blake2b
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import Stash, map_rows, small, text_of
from tablesmith.llm.counting import BLOCK_SCHEMA, BLOCKS, HELD, U, Tally, dealt, from_planes, levels, merged, pack_keys, planes, range_bits, ranges, resplit, unpack_keys
from tablesmith.llm.words import chunks, mix, spans, utf8, word_hashes

#: Hashes of a text's end, which is a token, and of its start, which is a context alone.
END, START = (mix(np.array([k], U))[0] for k in (0xE17D, 0x57A27))
#: A bigram's key is its first word's hash times this, plus its second word's hash.
FIRST = U(0x9FB21C651E98DF25)
#: Arrays that a worker keeps open, as a process may have so many maps only.
MAPS = 2048
_BIGRAMS = "part int, keys binary, firsts binary, counts binary"


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens in a row (words with A-Z lower-cased, then an end each), and each text's first place."""
    raw, at = utf8(column)
    raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    starts, ends, first = spans(raw, at)
    words = word_hashes(raw, starts, ends)
    return np.insert(words, first[1:], END), first + np.arange(len(first))


def contexts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The token before each token; the start of the text before its first."""
    before = np.concatenate([[START], hashes[:-1]]) if len(hashes) else hashes
    before[first[:-1]] = START
    return before


Counts = tuple[np.ndarray, np.ndarray, np.ndarray]


def _blocks(counted: Iterator[Counts], bits: int) -> Iterator[pa.RecordBatch]:
    """Counts put together as far as memory goes, as blocks for 2**bits ranges of keys."""
    held: list[Counts] = []

    def blocks() -> Iterator[pa.RecordBatch]:
        keys, firsts, counts = _sum(held)
        for i, cut in ranges(keys, bits):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *(pa.array([x], pa.binary()) for x in (pack_keys(keys[cut]), firsts[cut].tobytes(), planes(counts[cut])))], ["part", "keys", "firsts", "counts"])

    size = 0
    for some in counted:
        held.append(some)
        size += len(some[0])
        if size > HELD:
            held[:] = [_sum(held)]
            size = len(held[0][0])
            if size > HELD // 2:
                yield from blocks()
                held.clear()
                size = 0
    if held:
        yield from blocks()


def _count(bits: int):
    """Bigrams of texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[Counts]:
        for batch in small(batches):
            column = batch.column("text")
            for i, j in chunks(utf8(column)[1]):
                hashes, first = tokens(column[i:j])
                before = contexts(hashes, first)
                yield _sum([(before * FIRST + hashes, before, np.ones(len(hashes), np.int64))])

    return lambda batches: _blocks(counted(batches), bits)


def _resplit(bits: int):
    """Blocks of bigrams as blocks for more ranges."""
    return lambda batches: _blocks((c for batch in batches for c in _unpacked(batch)), bits)


def _unpacked(table: pa.Table | pa.RecordBatch) -> Iterator[Counts]:
    for keys, firsts, counts in zip(*(table.column(c).to_pylist() for c in ("keys", "firsts", "counts")), strict=True):
        yield unpack_keys(keys), np.frombuffer(firsts, U), from_planes(counts, np.int64)


def _sum(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, their first words, and their counts' sums."""
    keys, firsts, counts = (np.concatenate(x) for x in zip(*parts))
    if len(keys):
        order = np.argsort(keys, kind="stable")
        keys, firsts, counts = keys[order], firsts[order], counts[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, firsts, counts = keys[new], firsts[new], np.add.reduceat(counts, new)
    return keys, firsts, counts


def _write(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Arrays as files of the shared folder, each moved into place whole, so that a task that runs again does no harm."""
    system, path = fs.FileSystem.from_uri(folder)
    for kind, array in arrays.items():
        temporary = f"{path}/.{name}.{kind}.{uuid.uuid4().hex}"
        with system.open_output_stream(temporary) as out:
            out.write(np.ascontiguousarray(array).tobytes())
        system.move(temporary, f"{path}/{name}.{kind}")


def _narrow(kind: str, counts: np.ndarray, dtype) -> dict[str, np.ndarray]:
    """Counts as arrays to write: in a narrow type, whose largest value sends to the few larger counts by their places."""
    flat, most = counts.reshape(-1), np.iinfo(dtype).max
    big = np.flatnonzero(flat >= most)
    return {kind: np.minimum(flat, most).astype(dtype), f"{kind}_at": big.astype(np.int64), f"{kind}_big": flat[big].astype(np.int64)}


def _bigrams(folder: str, bits: int):
    """Writes a range of bigrams, and hands on what contexts and words need of them, for 2**bits ranges of these."""

    def run(table: pa.Table) -> pa.Table:
        keys, firsts, counts = _sum(list(_unpacked(table)))
        _write(folder, f"bigram-{table.column('part')[0].as_py()}", keys=keys, **_narrow("counts", counts, np.uint8))
        held = Tally(bits)
        seconds, one = keys - firsts * FIRST, np.ones(len(keys), np.int64)
        held.add("total", firsts, counts)
        held.add("n1", firsts[counts == 1])
        held.add("n2", firsts[counts == 2])
        held.add("n3", firsts[counts > 2])
        held.add("contexts", seconds, one)
        held.add("count", seconds, counts)
        held.add("bigrams", np.arange(1, 5, dtype=U), np.array([(counts == k).sum() for k in range(1, 5)]))
        return pa.Table.from_batches(list(held.blocks()), BLOCK_SCHEMA)

    return run


def _singles(folder: str):
    """Writes a range of contexts and of words, and returns figures to be summed: (name, value)."""

    def run(table: pa.Table) -> pa.Table:
        part, by = table.column("part")[0].as_py(), merged(table)
        none = np.zeros(0, U), np.zeros(0, np.int64)
        keys, totals = by.get("total", none)
        kinds = [np.zeros(len(keys), np.int64) for _ in range(3)]
        for kind, tag in zip(kinds, ("n1", "n2", "n3")):
            own, counts = by.get(tag, none)
            kind[np.searchsorted(keys, own)] = counts
        _write(folder, f"context-{part}", keys=keys, **_narrow("total", totals, np.uint16), **_narrow("kinds", np.column_stack(kinds), np.uint16))
        words, counts = by.get("count", none)
        met = by.get("contexts", none)[1]
        _write(folder, f"word-{part}", keys=words, **_narrow("count", counts, np.uint16), **_narrow("contexts", met, np.uint16))
        out = {"tokens": int(counts.sum()), "words": len(words), "pairs": int(met.sum())}
        out |= {f"word{k}": int((met == k).sum()) for k in range(1, 5)}
        out |= {f"bigram{k}": int(c) for k, c in zip(*by["bigrams"])} if "bigrams" in by else {}
        return pa.table({"name": list(out), "value": list(out.values())}, pa.schema([("name", pa.string()), ("value", pa.int64())]))

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and more, from the numbers of counts 1 to 4."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = [k - (k + 1) * y * more / some if some and more else 0.5 * k for k, some, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(d, 0.1 * k), 0.95 * k) for k, d in enumerate(found, 1))])


class Model:
    """Where a trained model's arrays lie, and its few figures."""

    def __init__(self, folder: str, bits: dict[str, int], figures: dict[str, int]):
        """bits: 2**bits ranges of keys that a table's arrays are split into."""
        self.folder, self.bits, self.figures = folder, bits, figures
        self.discount = {k: discounts(*(figures.get(f"{k}{n}", 0) for n in range(1, 5))) for k in ("word", "bigram")}

    def array(self, name: str, kind: str, dtype) -> np.ndarray:
        """A memory-mapped array; where the shared folder is no file system of this machine, of one copy for all of its workers."""
        held = self.__dict__.setdefault("_arrays", {})
        if (name, kind) in held:
            held[name, kind] = held.pop((name, kind))  # the latest comes last
        else:
            if len(held) >= MAPS:
                del held[next(iter(held))]
            path = f"{urlparse(self.folder).path}/{name}.{kind}"
            if urlparse(self.folder).scheme not in ("", "file"):
                path = self._copied(f"{name}.{kind}")
            some = os.path.exists(path) and os.path.getsize(path)
            held[name, kind] = np.memmap(path, dtype, "r") if some else np.zeros(0, dtype)
        return held[name, kind]

    def _copied(self, name: str) -> str:
        """A file of the shared folder as one of this machine, copied when it is first asked for and moved into place whole."""
        local = os.path.join(tempfile.gettempdir(), "lm-" + blake2b(self.folder.encode(), digest_size=12).hexdigest())
        path = os.path.join(local, name)
        if not os.path.exists(path):
            os.makedirs(local, exist_ok=True)
            system, far = fs.FileSystem.from_uri(self.folder)
            part = f"{path}.{uuid.uuid4().hex}"
            if system.get_file_info(f"{far}/{name}").type == fs.FileType.NotFound:
                open(part, "wb").close()
            else:
                fs.copy_files(f"{far}/{name}", part, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
            os.replace(part, path)
        return path

    def find(self, table: str, queries: np.ndarray, kinds: dict[str, tuple]) -> dict[str, np.ndarray]:
        """Values of sorted distinct keys, 0 where the table lacks one: {kind: (dtype, width)} to arrays of width columns."""
        out = {k: np.zeros((len(queries), width), np.int64) for k, (_, width) in kinds.items()}
        bounds = np.append(np.searchsorted(queries, np.arange(1 << self.bits[table], dtype=U) << U(64 - self.bits[table])), len(queries))
        for part in np.flatnonzero(np.diff(bounds)):
            mine = slice(bounds[part], bounds[part + 1])
            keys = self.array(f"{table}-{part}", "keys", U)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, queries[mine]), len(keys) - 1)
                there = np.flatnonzero(keys[at] == queries[mine])
                for kind, (dtype, width) in kinds.items():
                    places = at[there][:, None] * width + np.arange(width)
                    values = self.array(f"{table}-{part}", kind, dtype)[places].astype(np.int64)
                    big = values == np.iinfo(dtype).max
                    if big.any():
                        where = np.searchsorted(self.array(f"{table}-{part}", f"{kind}_at", np.int64), places[big])
                        values[big] = self.array(f"{table}-{part}", f"{kind}_big", np.int64)[where]
                    out[kind][bounds[part] + there] = values
        return out

    def log10(self, hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token after the one before, and the tokens' counts in training."""
        f, (dw, db) = self.figures, (self.discount["word"], self.discount["bigram"])
        words, word = np.unique(hashes, return_inverse=True)
        own = self.find("word", words, {"count": (np.uint16, 1), "contexts": (np.uint16, 1)})
        count, met = own["count"][:, 0], own["contexts"][:, 0]
        pairs = max(1, f["pairs"])
        rest = sum(dw[k] * f[f"word{k}"] for k in (1, 2)) + dw[3] * (f["words"] - f["word1"] - f["word2"])
        unigram = (met - dw[np.minimum(met, 3)]) / pairs + (rest / pairs if f["pairs"] else 1.0) / (f["words"] + 1)
        firsts, first = np.unique(before, return_inverse=True)
        context = self.find("context", firsts, {"total": (np.uint16, 1), "kinds": (np.uint16, 3)})
        mass, kinds = context["total"][:, 0], context["kinds"]
        left = np.where(mass > 0, kinds @ db[1:] / np.maximum(mass, 1), 1.0)
        keys, key = np.unique(before * FIRST + hashes, return_inverse=True)
        c = self.find("bigram", keys, {"counts": (np.uint8, 1)})["counts"][key, 0]
        p = (c - db[np.minimum(c, 3)]) / np.maximum(mass, 1)[first] + left[first] * unigram[word]
        return np.log10(p), count[word]


def train(docs: DataFrame) -> Model:
    """A model of docs(text, ...). Its arrays lie in the shared checkpoint folder.

    Each task counts its bigrams, summed before they travel as sorted blocks for ranges of keys; a range is merged,
    written, and hands on what it adds to contexts and words, which are merged and written likewise. Keys are hashes, so
    a frequent word's bigrams spread over all ranges. Only a dozen sums reach the driver. Words are told apart by 64-bit
    hashes. Ranges grow in number with the table (range_bits), so that each fits a worker; where they are many, blocks
    are dealt in several shuffles (levels), each to a bounded number of ranges at once. An empty table gives a model in
    which every token is unknown.
    """
    spark = docs.sparkSession
    bits, folder = range_bits(docs), Stash(spark, "lm").base
    folder = folder if "://" in folder or not folder.startswith("file:") else "file://" + folder[5:]
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    counted = dealt(docs.select(text_of().alias("text")).mapInArrow(_count(levels(bits)[0]), _BIGRAMS), bits, _resplit, _BIGRAMS)
    fewer = max(2, bits - 2)  # words and contexts are fewer than bigrams
    singles = dealt(counted.groupBy("part").applyInArrow(_bigrams(folder, levels(fewer)[0]), BLOCKS), fewer, resplit, BLOCKS)
    figures = singles.groupBy("part").applyInArrow(_singles(folder), "name string, value long").groupBy("name").agg(F.sum("value").alias("value"))
    zero = {k: 0 for k in ("tokens", "words", "pairs", "word1", "word2", "word3", "word4")}
    return Model(folder, {"bigram": bits, "context": fewer, "word": fewer}, zero | {r["name"]: r["value"] for r in figures.collect()})


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity) for each row of docs(doc_id, text, ...).

    Tokens are the words, with A-Z lower-cased, and one end. score is the text's log10 probability: bigram counts with
    modified Kneser-Ney discounts, interpolated with continuation counts of the words, and these with an even chance
    for all known words and one unknown. perplexity is that of a token, 10 ** (-score / n_tokens). base_score is that of single tokens' counts plus 0.5; n_known counts tokens
    that training had. Workers memory-map the model's sorted arrays and look a batch's distinct keys up in order.

    Null is the empty text, whose only token is the end. Whole texts are scored at any length. Repeated rows give a row
    each. Extra columns are ignored; an empty table gives no rows.
    """
    f = model.figures
    norm = f["tokens"] + 0.5 * (f["words"] + 1)

    def run(batch: pa.RecordBatch) -> dict:
        column, out = batch.column("text"), {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
        for i, j in chunks(utf8(column)[1]):
            hashes, first = tokens(column[i:j])
            logs, counts = model.log10(hashes, contexts(hashes, first))
            out["n_tokens"].append(np.diff(first))
            for name, values in (("n_known", (counts > 0).astype(np.int64)), ("base_score", np.log10((counts + 0.5) / norm)), ("score", logs)):
                out[name].append(np.add.reduceat(values, first[:-1]))
        done = {k: np.concatenate(v) for k, v in out.items()}
        done["perplexity"] = 10 ** np.minimum(300, -done["score"] / done["n_tokens"])
        return {k: pa.array(v) for k, v in done.items()} | {"doc_id": batch.column("doc_id")}

    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double"
    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), run, schema)
