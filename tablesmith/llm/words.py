"""Vectorised words and word shingles of Arrow text columns: all work is NumPy over the UTF-8 buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = U(0x9E6C63D0876A9A47)
#: Words of a shingle, and the similarity from which two texts are near-duplicates.
SHINGLE_WORDS, SIMILARITY = 5, 0.8

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A byte's value in a word's hash; spaces add nothing.
_VALUE = np.where(_SPACE, U(0), np.arange(1, 257, dtype=U))
_powers = {False: np.ones(1, U), True: np.ones(1, U)}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the splitmix64 constants)."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of BASE, or of its inverse modulo 2**64, from 0 to n - 1 at least."""
    while len(_powers[inverse]) < n:
        base = U(pow(int(BASE), -1, 1 << 64)) if inverse else BASE
        _powers[inverse] = np.concatenate([_powers[inverse], _powers[inverse] * _powers[inverse][-1] * base])
    return _powers[inverse]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each text starts (one more for the end); null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text where its words start (one more for the end)."""
    word = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    before = np.concatenate([[False], word])
    after = np.concatenate([word, [False]])
    starts = np.flatnonzero(after & (edge | ~before))
    ends = np.flatnonzero(before & (edge | ~after))
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word's bytes; starts and ends are those of all words of raw, in order."""
    if not len(starts):
        return np.zeros(0, U)
    values = _VALUE[raw]
    values *= powers(len(raw))[: len(raw)]
    return mix(np.add.reduceat(values, starts) * powers(len(raw), True)[starts] + (ends - starts).astype(U))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions have none."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    total = np.zeros(m, U)
    for j in range(n):
        total += words[j : j + m] * (powers(n + 1)[j + 1] | U(1))
    return mix(total)


def shingles(column: pa.Array, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each text's start.

    A text of fewer than n words (but some) has one shingle, all its words; a text without words has none.
    """
    raw, at = utf8(column)
    starts, ends, first = spans(raw, at)
    words = word_hashes(raw, starts, ends)
    count = np.diff(first)
    hashes = ngram_hashes(words, n)
    doc = np.repeat(np.arange(len(count)), count)
    good = np.flatnonzero(doc[: len(hashes)] == doc[n - 1 :][: len(hashes)]) if len(hashes) else np.zeros(0, int)
    owner, value = doc[good], hashes[good]
    for d in np.flatnonzero((count > 0) & (count < n)):
        owner = np.append(owner, d)
        value = np.append(value, ngram_hashes(words[first[d] : first[d + 1]], int(count[d])))
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    if len(value):
        keep = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])
        owner, value = owner[keep], value[keep]
    return value, np.searchsorted(owner, np.arange(len(count) + 1))


def chunks(at: np.ndarray, most: int = 1 << 20):
    """Ranges of texts that together have about most bytes at most."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def similar_pairs(sets: list[np.ndarray], cross: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of both texts of each pair that reaches the similarity, and that. cross > 0: one of the first `cross` texts and a later one."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    owner, value = np.repeat(np.arange(n), sizes), np.concatenate(sets)
    _, column, df = np.unique(value, return_inverse=True, return_counts=True)
    shared = df[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [low, low + width])
        has = np.zeros((n, min(width, int(column[-1]) + 1 - low)), np.float32)
        has[owner[i:j], column[i:j] - low] = 1
        both += has @ has.T
    linked = np.triu(both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-6, 1)
    if cross:
        linked[:cross, :cross] = False
        linked[cross:, cross:] = False
    a, b = np.nonzero(linked)
    shared_by = both[a, b].astype(np.int64)
    similarity = shared_by / np.maximum(1, sizes[a] + sizes[b] - shared_by)
    good = similarity >= threshold - 1e-9
    return a[good], b[good], similarity[good]
