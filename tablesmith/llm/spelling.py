"""Spelling variants by anagram hashing: words that differ by one inserted, deleted or replaced letter.

A word's value is the sum of its letters' fifth powers. One letter less lowers the value by that letter's power, and a
word of which another letter is replaced has the same lowered value; so near words meet at a lowered value, either two
words with a letter less each, or one with a letter less and one whole. Values do not tell the order of letters: words
meet only where they also agree on the half of their letters that the change has left alone, and the pairs that meet are
then compared exactly.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import Stash, map_rows, small, text_of

#: Letters of a run; only A-Z are put into lower case.
RUN = re.compile("[a-zÀ-ÿ]+")
#: One occurrence in so many has a letter dropped, by its hash.
TYPO = 31
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: How many times as frequent as a word its form has to be.
RATIO = 10
#: The exponent that tells sums of letters apart.
POWER = 5
#: Different words that a task counts before it hands its counts on.
HELD = 200_000
_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def runs(text: str) -> Counter:
    """How often each maximal run of letters occurs, in lower case as far as A-Z go."""
    return Counter(RUN.findall(text.encode().lower().decode()))


def misspelt(run: str, before: int) -> str:
    """The run, or what a dropped letter leaves of it; before: the CRC-32 of what precedes the run in the hashed text."""
    h = zlib.crc32(run.encode(), before)
    if h % TYPO:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough, over all documents; null texts have no words, a null doc_id is hashed as no digits.

    Tasks count what they read and shuffle a row for each different word, so that a word that is in all texts costs its
    task a row from each other task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in small(batches):
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in runs(text).items():
                    if len(run) >= LEAST_LENGTH and len(word := misspelt(run, before)) >= LEAST_LENGTH:
                        held[word] += n
            if len(held) >= HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=_WORDS)
                held.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=_WORDS)

    counted = docs.select("doc_id", text_of().alias("text")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _half(length: int, last: bool, letters: str) -> int:
    """A number of a half of a word of this length."""
    return zlib.crc32(letters.encode(), 2 * length + last)


def meetings(word: str) -> list[tuple[int, int, bool]]:
    """(value, half, whole) of every place where a word can meet a near one.

    A word of so many letters keeps its first half if the change is behind it, and its last half if the change is before
    it; the lost letter is one of the other half. A word meets those with a letter more as it is, as one of their
    length.
    """
    powers = [ord(c) ** POWER for c in word]
    value, length = sum(powers), len(word)
    middle = length // 2
    first, last = _half(length, False, word[:middle]), _half(length, True, word[middle:])
    out = [(value - p, first, False) for p in set(powers[middle:])] + [(value - p, last, False) for p in set(powers[:middle])]
    longer = length + 1
    middle = longer // 2
    return [*out, (value, _half(longer, False, word[:middle]), True), (value, _half(longer, True, word[length - (longer - middle) :]), True)]


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b) of all pairs of near words, once, a before b in code-point order; from (word, n) of different words."""

    def meet(batch: pa.RecordBatch) -> dict:
        made = [meetings(w) for w in batch["word"].to_pylist()]
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        flat = [m for each in made for m in each]
        rows = pa.array(np.repeat(np.arange(len(made)), sizes))
        value = np.array([m[0] & 0xFFFFFFFFFFFFFFFF for m in flat], np.uint64).view(np.int64)  # sums of very long words wrap round
        return {"value": pa.array(value), "half": pa.array([m[1] for m in flat], pa.int64()), "whole": pa.array([m[2] for m in flat]), "word": batch["word"].take(rows), "n": batch["n"].take(rows)}

    placed = map_rows(words, meet, "value long, half long, whole boolean, word string, n long")
    other = placed.toDF("value", "half", "whole_b", "b", "n_b")
    met = placed.join(other, ["value", "half"]).filter("word < b and not (whole and whole_b)")
    near = met.filter(F.levenshtein("word", "b", 1) == 1)
    return near.groupBy(F.col("word").alias("a"), "b").agg(F.first("n").alias("n_a"), F.first("n_b").alias("n_b"))


def variants(docs: DataFrame) -> DataFrame:
    """(word, n, form, root, n_near, form_n) of every word of docs.

    form: the near word of largest n, of those the first in code-point order, if its n is RATIO times the word's or more;
    root: where following forms from the word ends, the word itself if it has no form. Repeated rows count each for
    itself; no documents give no rows.
    """
    stash = Stash(docs.sparkSession, "spelling")
    words = stash(word_counts(docs))
    pairs = near_pairs(words)
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n_other")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("n_other")))).alias("e")).select("e.*")
    best = F.min(F.struct((-F.col("n_other")).alias("rank"), "other"))
    near = ends.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    formed = F.col("n_near").isNotNull() & (-F.col("best.rank") >= RATIO * F.col("n"))
    known = stash(
        words.join(near, "word", "left").select("word", "n", F.when(formed, F.col("best.other")).alias("form"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, -F.col("best.rank")).alias("form_n"))
    )
    stash.drop(words)
    roots = _roots(known.filter("form is not null").select("word", F.col("form").alias("root")), stash)
    return known.join(roots, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def _roots(up: DataFrame, stash: Stash) -> DataFrame:
    """(word, root) from (word, form): pointers jump twice as far in each round.

    A form is RATIO times as frequent as its word, so that no chain has more steps than a count has digits.
    """
    up = stash(up)
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("top"))
        jumped = stash(up.join(further, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
        stash.drop(up)
        up = jumped.select("word", "root")
        up.stash_path = jumped.stash_path
        if jumped.filter("moved").isEmpty():
            return up
