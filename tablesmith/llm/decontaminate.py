"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted similarity."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import map_rows, small, text_of
from tablesmith.llm.words import SHINGLE_WORDS, SIMILARITY, U, chunks, ngram_hashes, spans, utf8, word_hashes

#: Bits that a fingerprint may differ in, of 64 in four blocks of 16: one block then differs in RADIUS // BLOCKS bits at
#: most, of which the index holds up to ITEM_BITS and a look-up tries the others.
RADIUS, BLOCKS, ITEM_BITS = 19, 4, 1
#: Lengths up to this ratio share windows; windows start at every thirty-second part of their length.
ALIKE, STEPS = 1.08, 32
#: Windows that are looked up together.
ASKED = 64
#: Items of one pass over the documents, whose index takes some 100 MB; more items take more passes.
ITEMS = 1 << 16
#: A shingle's weight: the mean length of its words in bytes, in whole numbers up to this.
HEAVIEST = 8
#: Shingles of a window from which its weights may overflow a lane of 16 bits, so that its lanes are summed one by one.
WIDE = (1 << 16) // HEAVIEST
MATCH = "doc_id long, item_id long, start_word long, n_words long, similarity double, via string"


def _within(bits: int) -> np.ndarray:
    """All 16-bit values of up to so many bits."""
    return np.array([sum(1 << b for b in ones) for r in range(bits + 1) for ones in combinations(range(16), r)], np.uint16)


def weighted_shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and weight of the five words from each place on, and each text's first place and the one after its last.

    Places count words; the last four of a text have no shingle and lie beyond its end. Letters are lower-cased.
    """
    raw, at = utf8(pc.utf8_lower(column))
    starts, ends, first = spans(raw, at)
    hashes = ngram_hashes(word_hashes(raw, starts, ends), SHINGLE_WORDS)
    length = np.concatenate([[0], np.cumsum(ends - starts)])
    mean = (length[SHINGLE_WORDS:] - length[:-SHINGLE_WORDS]) // SHINGLE_WORDS if len(hashes) else np.zeros(0, int)
    return hashes, np.clip(mean, 1, HEAVIEST), first[:-1], np.maximum(first[:-1], first[1:] - SHINGLE_WORDS + 1)


#: For each value of a byte, its bits as eight lanes of 16 bits in two words.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.uint16).view(U)


def lane_sums(hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums, from 0 on, of the weights in each of 64 lanes (where a hash has the bit), four lanes a word, and of all weights.

    A word's sums carry over into each other, yet differences of words are right if every lane's own is below 2**16.
    """
    lanes = np.take(_LANES, hashes.view(np.uint8), axis=0).reshape(-1, 16)
    lanes *= weights.astype(U)[:, None]
    sums = np.zeros((len(hashes) + 1, 16), U)
    np.cumsum(lanes, axis=0, out=sums[1:])
    return sums, np.concatenate([[0], np.cumsum(weights)])


def fingerprints(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bits of a window that more than half of its weight has."""
    lanes, weights = sums
    window = np.take(lanes, end, axis=0)
    window -= np.take(lanes, start, axis=0)
    half = ((weights[end] - weights[start]) // 2).astype(np.uint16)
    return np.packbits(window.view(np.uint16) > half[:, None], axis=1, bitorder="little").view(U).reshape(-1)


def wide_fingerprints(hashes: np.ndarray, weights: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """fingerprints() of windows of any weight: one running sum after the other, so that memory does not grow with the lanes."""
    total = np.concatenate([[0], np.cumsum(weights)])
    half, out = (total[end] - total[start]) // 2, np.zeros(len(start), U)
    for bit in range(64):
        lane = np.concatenate([[0], np.cumsum(weights * (hashes >> U(bit) & U(1)).astype(np.int64))])
        out |= (lane[end] - lane[start] > half).astype(U) << U(bit)
    return out


class Index:
    """Items grouped by about their length, with a multi-index from a length and a block's value to the items that may be near.

    An entry leads from the number of a group of lengths, a block and each of its values within ITEM_BITS bits of an
    item's to that item; a look-up tries all values within the other bits of RADIUS // BLOCKS. Any two fingerprints
    within RADIUS bits agree in a block but for so many bits, so look-ups lead to all of them. What a look-up costs does
    not depend on the number of items, but for those that it finds.
    """

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray, int, int]]):
        """items: (item_id, distinct shingles, their weights, fingerprint, number of shingles), sorted by that number."""
        self.items = items
        self.prints = np.array([x[3] for x in items], U)
        #: For each group: the first item's place; and what is searched with: the windows' length and the least weight.
        self.bounds = [0] if items else []
        for k, x in enumerate(items):
            shortest = items[self.bounds[-1]][4]
            if x[4] > max(shortest + 0.5, ALIKE * shortest):
                self.bounds.append(k)
        self.bounds.append(len(items))
        ranges = list(zip(self.bounds, self.bounds[1:]))
        self.sizes = [(items[i][4] + items[j - 1][4] + 1) // 2 for i, j in ranges]
        self.least = [min(int(x[2].sum()) for x in items[i:j]) for i, j in ranges]
        near = _within(ITEM_BITS).astype(U)
        group = np.repeat(np.arange(len(ranges), dtype=U), [j - i for i, j in ranges])
        keys = [(group << U(18) | U(block << 16))[:, None] | (self.prints >> U(16 * block) & U(0xFFFF))[:, None] ^ near for block in range(BLOCKS)]
        key = np.concatenate(keys).reshape(-1) if items else np.zeros(0, U)
        owner = np.tile(np.repeat(np.arange(len(items), dtype=np.uint32), len(near)), BLOCKS)
        order = np.argsort(key, kind="stable")
        self.keys, self.owners = key[order], owner[order]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_some"}

    def hits(self, group: int, prints: np.ndarray) -> list[tuple[int, int]]:
        """(print, item) by places, of all prints and items of a group of lengths within RADIUS."""
        if "_some" not in self.__dict__:
            self._some = np.zeros(len(self.sizes) << 18, bool)
            self._some[self.keys] = True
        tried = _within(RADIUS // BLOCKS - ITEM_BITS)
        words = prints.view(np.uint16).reshape(-1, BLOCKS)
        out: list[np.ndarray] = []
        for low in range(0, len(prints), ASKED):
            for block in range(BLOCKS):
                values = words[low : low + ASKED, block][:, None] ^ tried
                some = np.take(self._some[(group << 18) + (block << 16) :][: 1 << 16], values)
                place, _ = np.nonzero(some)
                key = values[some].astype(U) | U((group << 18) + (block << 16))
                first = np.searchsorted(self.keys, key, "left")
                n = np.searchsorted(self.keys, key, "right") - first
                each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pair = np.unique((np.repeat(place, n) + low).astype(U) << U(32) | self.owners[np.repeat(first, n) + each].astype(U))
                near = np.bitwise_count(prints[pair >> U(32)] ^ self.prints[pair & U(0xFFFFFFFF)]) <= RADIUS
                out.append(pair[near])
        found = np.unique(np.concatenate(out)) if out else np.zeros(0, U)
        return list(zip((found >> U(32)).tolist(), (found & U(0xFFFFFFFF)).tolist(), strict=True))


def index(items: list[tuple[int, str]]) -> Index:
    """An index of items, each by its own whole fingerprint; items of no shingle are left out."""
    made = []
    for low in range(0, len(items), 512):
        some = items[low : low + 512]
        hashes, weights, first, end = weighted_shingles(pa.array([text or "" for _, text in some], pa.large_string()))
        full = np.flatnonzero(end > first)
        prints = wide_fingerprints(hashes, weights, first[full], end[full])
        for k, print_ in zip(full.tolist(), prints.tolist()):
            keys, at = np.unique(hashes[first[k] : end[k]], return_index=True)
            made.append((some[k][0], keys, weights[first[k] : end[k]][at].astype(np.uint8), print_, int(end[k] - first[k])))
    return Index(sorted(made, key=lambda x: x[4]))


def similarity(hashes: np.ndarray, weights: np.ndarray, keys: np.ndarray, key_weights: np.ndarray) -> float:
    """Weighted Jaccard similarity of a window's shingles and an item's."""
    mine, first = np.unique(hashes, return_index=True)
    both = int(key_weights[np.isin(keys, mine, assume_unique=True)].sum())
    return both / (int(weights[first].sum()) + int(key_weights.sum()) - both)


def anchors(found: Index, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes, and the item of each: an item's heaviest shingles, of more than 1 - threshold of its weight.

    A window that has none of them is less similar than the threshold, so that they lead to all passages.
    """
    hashes, owners = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for k, (_, keys, weights, _, _) in enumerate(found.items):
        order = np.argsort(-weights.astype(np.int64), kind="stable")
        n = int(np.searchsorted(np.cumsum(weights[order], dtype=np.int64), (1 - threshold) * weights.sum() + 1e-9, "right")) + 1
        hashes.append(keys[order[:n]])
        owners.append(np.full(len(hashes[-1]), k))
    every, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(every, kind="stable")
    return every[order], owner[order]


def _anchored(found: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, first: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, first place, last place) of the anchors of an item that a text has."""
    keys, owners = found
    some = np.zeros(1 << 20, bool)
    some[keys & U(len(some) - 1)] = True
    at = np.flatnonzero(some[hashes & U(len(some) - 1)])
    low, high = np.searchsorted(keys, hashes[at], "left"), np.searchsorted(keys, hashes[at], "right")
    full = np.flatnonzero(end > first)
    text = full[np.maximum(np.searchsorted(first[full], at, "right") - 1, 0)] if len(full) else at
    right = (high > low) & (at >= first[text]) & (at < end[text])
    at, text, low, n = at[right], text[right], low[right], (high - low)[right]
    each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    ranges: dict[tuple[int, int], tuple[int, int]] = {}
    for d, p, k in zip(np.repeat(text, n).tolist(), np.repeat(at, n).tolist(), owners[np.repeat(low, n) + each].tolist()):
        ranges[d, k] = (ranges.get((d, k), (p, p))[0], p)
    for key, places in ranges.items():
        yield *key, *places


def _windows(found: Index, hashes: np.ndarray, weights: np.ndarray, group: int, low: int, high: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and fingerprints of the windows of a group's length that start from low to high, at each step and at both, in a text that ends at end."""
    size = found.sizes[group]
    start = np.unique(np.append(np.arange(low, high + 1, max(1, size // STEPS)), high))
    stop = np.minimum(start + size, end)
    part = slice(low, min(high + size, end))
    if size < WIDE:
        return start, fingerprints(lane_sums(hashes[part], weights[part]), start - low, stop - low)
    return start, wide_fingerprints(hashes[part], weights[part], start - low, stop - low)


def _search(found: Index, threshold: float, rest: bool = True):
    """A function from a batch of documents to rows of MATCH; rest: anchors lead to what fingerprints have missed."""
    found_by = anchors(found, threshold)
    group_of = np.searchsorted(np.array(found.bounds[1:]), np.arange(len(found.items)), "right") if found.items else np.zeros(0, int)

    def run(batch: pa.RecordBatch) -> dict:
        text, ids = batch.column("text"), batch.column("doc_id").to_pylist()
        rows: dict[tuple[int, int], tuple] = {}
        for i, j in chunks(utf8(text)[1], 1 << 18):
            hashes, weights, first, end = weighted_shingles(text[i:j])
            if not len(hashes):
                continue

            def compare(d: int, low: int, high: int, part: tuple, via: str) -> None:
                """Keep the best window of those from low to high, passing over what has too little of the item's weight."""
                item, keys, key_weights, _, size = part
                seg = slice(low, min(int(end[d]), high + size))
                inside = np.concatenate([[0], np.cumsum(weights[seg] * np.isin(hashes[seg], keys))])
                starts = np.arange(low, high + 1)
                stops = np.minimum(starts + size, int(end[d]))
                enough = inside[stops - low] - inside[starts - low] >= threshold * key_weights.sum() - 1e-9
                for s, e in zip(starts[enough].tolist(), stops[enough].tolist()):
                    got = similarity(hashes[s:e], weights[s:e], keys, key_weights)
                    best = rows.get((i + d, item))
                    if got >= threshold - 1e-12 and (best is None or (-got, s) < best[:2]):
                        rows[i + d, item] = (-got, s, s - int(first[d]), e - s + SHINGLE_WORDS - 1, via if best is None else best[4])

            near = [(d, k, max(int(first[d]), p - found.items[k][4] + 1), min(int(end[d]) - 1, q)) for d, k, p, q in _anchored(found_by, hashes, first, end)]
            places: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for d, k, low, high in near:
                slack = abs(found.sizes[group_of[k]] - found.items[k][4])
                places.setdefault((d, int(group_of[k])), []).append((max(int(first[d]), low - slack), min(int(end[d]) - 1, high + slack)))
            for (d, group), ranges in places.items():
                reached: dict[int, tuple[int, int]] = {}
                for low, high in _merged(ranges):
                    starts, prints = _windows(found, hashes, weights, group, low, high, int(end[d]))
                    for window, k in found.hits(group, prints):
                        s = int(starts[window])
                        reached[k] = (min(reached.get(k, (s, s))[0], s), max(reached.get(k, (s, s))[1], s))
                for k, (low, high) in reached.items():
                    slack = max(1, found.sizes[group] // STEPS) + abs(found.sizes[group] - found.items[k][4])
                    compare(d, max(int(first[d]), low - slack), min(int(end[d]) - 1, high + slack), found.items[k], "simhash")
            for d, k, low, high in near if rest else ():
                compare(d, low, high, found.items[k], "anchor")
        held = sorted(rows.items(), key=lambda x: (x[0][0], x[0][1] is None, x[0][1] or 0))
        return {
            "doc_id": [ids[d] for (d, _), _ in held],
            "item_id": [item for (_, item), _ in held],
            "start_word": [x[2] for _, x in held],
            "n_words": [x[3] for _, x in held],
            "similarity": [-x[0] for _, x in held],
            "via": [x[4] for _, x in held],
        }

    return run


def _merged(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The union of ranges, as ranges that do not meet."""
    now: tuple[int, int] | None = None
    for low, high in sorted(ranges):
        if now and low <= now[1] + 1:
            now = now[0], max(now[1], high)
        else:
            if now:
                yield now
            now = low, high
    if now:
        yield now


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Items of benchmark(item_id, text) that docs(doc_id, text, ...) hold: one row for each row of docs and item.

    No window that reaches the threshold lacks all of an item's heaviest shingles (those of more than 1 - threshold of
    its weight), so only windows round such a shingle are looked at. They get a 64-bit SimHash of their weighted
    five-word shingles at each STEPS-th part of the items' length, and four blocks of 16 bits lead to all items within
    RADIUS bits. Around each hit the item-sized windows at every word are compared with the item by exact weighted
    Jaccard similarity; the best is returned if it reaches the threshold, with its first word, its number of words and
    the similarity. via tells what led to the item: its fingerprint ("simhash"), or, where that is further off than
    RADIUS, the heavy shingle alone ("anchor"), so that no match is lost.

    The documents are the large side and never shuffled. The benchmark goes to the tasks as one index, in one pass over the
    documents, up to ITEMS items; for each such number more there is a further pass, so that memory stays bounded. Letters are
    compared in lower case. Null is the empty text. Texts and items of fewer than five words have no shingles and never
    match. Very long texts are searched whole, and for very long items as a whole. Repeated rows of docs give the same rows twice;
    items that repeat an item_id give one row, that of the best. Extra columns are ignored; an empty table of either
    kind gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    parts = [map_rows(texts, _search(index(block), threshold), MATCH) for block in _blocks(benchmark)]
    return reduce(DataFrame.unionAll, parts)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows, ITEMS at a time; one empty block if there are none."""
    rows = (tuple(r) for r in benchmark.select(F.col("item_id").cast("long"), text_of()).toLocalIterator())
    yield list(islice(rows, ITEMS))
    while block := list(islice(rows, ITEMS)):
        yield block


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Rows of docs that hold no item, with the columns of docs: a filter for each block of items, without a join.

    Null and empty texts hold none. Repeated rows stay or go together. Empty tables of either kind take nothing away.
    """
    for block in _blocks(benchmark):
        docs = docs.mapInArrow(_clean(_search(index(block), threshold)), docs.schema)
    return docs


def _clean(search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            places = pa.array(np.arange(batch.num_rows))
            found = search(pa.RecordBatch.from_pydict({"doc_id": places, "text": batch.column("text").fill_null("")}))
            clean = np.ones(batch.num_rows, bool)
            clean[found["doc_id"]] = False
            yield batch.filter(pa.array(clean))

    return run
