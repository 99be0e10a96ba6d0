"""Toxicity by a weighted lexicon, matched by Aho-Corasick after folding, normalised by length, with exception phrases."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import Stash, map_rows, small, text_of
from tablesmith.llm.sieve import Sieve

#: Labelled rows that the lexicon and the calibration are learnt from, at most: those of the least hashes of doc_id.
TRAIN_ROWS = 20_000
#: Entries of the lexicon and of the exceptions, at most; documents that an entry needs; and its least weight.
ENTRIES, LEAST_DOCS, LEAST_WEIGHT = 5000, 4, 1.5
#: Lengths of words' beginnings that may be entries of their own.
STEMS = (4, 5, 6)
#: Words added to a text's length before its weight is divided by it, and the score from which it is toxic.
SHORT, TOXIC = 10, 0.3

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "һ": "h",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "m", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss",
}
#: Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
#: Separates words in a folded text, and marks a whole word's ends in an entry.
GAP = "\n"


class _Folding(dict):
    """A character's folded form: letters and their look-alikes, or the gap; made as characters turn up."""

    def __missing__(self, code: int) -> str:
        out = ""
        for c in unicodedata.normalize("NFKD", chr(code)).lower():
            c = HOMOGLYPHS.get(c, SUBSTITUTES.get(c, c))
            if c.isalnum():
                out += c
            elif not unicodedata.combining(c):
                out += GAP
        self[code] = out
        return out


_folding = _Folding()


def fold(text: str) -> list[str]:
    """Folded words: lower case without accents, look-alikes and substitutes as the letters that they stand for.

    Signs that stand for letters do so within a word only: at a word's end, ! and the like fall away.
    """
    return [w for w in GAP.join(part.strip("!$@.,;:?\"'()[]{}") for part in text.split()).translate(_folding).split(GAP) if w]


def features(words: list[str]) -> set[str]:
    """Entries that a text's words may match: whole words, and beginnings of longer ones."""
    out = set()
    for w in set(words):
        out.add(f"{GAP}{w}{GAP}")
        out.update(GAP + w[:n] for n in STEMS if len(w) > n)
    return out


class Lexicon:
    """Weights of entries, and phrases in which an entry does not count."""

    def __init__(self, weights: dict[str, float], exceptions: frozenset[str], line: tuple[float, float, float]):
        self.weights, self.exceptions, self.line = weights, exceptions, line

    @property
    def automaton(self):
        """Built when first asked for, and not sent along with the lexicon."""
        if "_automaton" not in self.__dict__:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._automaton.add_word(entry, (len(entry), weight))
            self._automaton.make_automaton()
        return self._automaton

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"}

    def hits(self, words: list[str]) -> dict[int, float]:
        """The heaviest entry's weight for each matched word, by its place; exceptions left out."""
        if not self.weights or not words:
            return {}
        text = GAP + GAP.join(words) + GAP
        best: dict[int, float] = {}
        for end, (size, weight) in self.automaton.iter(text):
            start = end - size + 1
            best[start] = max(weight, best.get(start, 0.0))
        if not best:
            return {}
        places, at = {}, 0
        for k, w in enumerate(words):
            places[at] = k
            at += len(w) + 1
        return {k: v for start, v in best.items() if not self.excepted(words, k := places[start])}

    def excepted(self, words: list[str], k: int) -> bool:
        return k > 0 and f"{words[k - 1]} {words[k]}" in self.exceptions or k + 1 < len(words) and f"{words[k]} {words[k + 1]}" in self.exceptions

    def measures(self, words: list[str]) -> tuple[float, float]:
        """The weight of all hits and that of a hundred words, both on a logarithmic scale."""
        total = sum(self.hits(words).values())
        return math.log1p(total), math.log1p(100 * total / (len(words) + SHORT))

    def score(self, text: str) -> float:
        a, b = self.measures(fold(text))
        c0, c1, c2 = self.line
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, c0 + c1 * a + c2 * b))))


def _counts(make) -> object:
    """A mapInArrow function that counts the features of each task's texts by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            keys = list(toxic.keys() | clean.keys())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())], ["entry", "toxic", "clean"])

        for batch in small(batches):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                (toxic if label else clean).update(make(fold(text)))
            if len(toxic) + len(clean) > 500_000:
                yield rows()
                toxic.clear()
                clean.clear()
        yield rows()

    return run


COUNTS = "entry string, toxic long, clean long"


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """A lexicon from labelled texts: docs(doc_id, text) with labels(doc_id, toxic).

    At most TRAIN_ROWS labelled rows count, those of the least hashes of doc_id; three quarters of them give the
    entries (log odds of a word or a word's beginning in toxic documents) and the exceptions (two words in a row, one
    of them matched, that clean documents have at least as often), the rest calibrate the score.

    Null labels and labels without a document teach nothing; of several labels of a document a toxic one counts. Null
    texts are empty. Repeated rows of docs count each. Without toxic texts there are no entries and all texts score alike.
    Extra columns are ignored; empty tables give a lexicon without entries.
    """
    spread = F.xxhash64("doc_id", F.lit("toxicity"))
    known = labels.filter(F.col("toxic").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("toxic"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(spread, "doc_id").limit(TRAIN_ROWS)
    stash = Stash(docs.sparkSession, "toxicity")
    known = stash(known)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = stash(Sieve(known, "doc_id").keep(texts, "doc_id").hint("merge").join(known, "doc_id"))
    part = F.pmod(spread, F.lit(4)) == 0
    lesson = rows.filter(~part).select("text", "toxic")
    n = lesson.groupBy("toxic").count().collect()
    n_toxic, n_clean = (sum(r["count"] for r in n if r["toxic"] is flag) for flag in (True, False))
    entries = lesson.mapInArrow(_counts(features), COUNTS).groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    best = entries.filter(F.col("toxic") >= LEAST_DOCS).withColumn("weight", weight).filter(F.col("weight") >= LEAST_WEIGHT)
    weights = {r["entry"]: r["weight"] for r in best.orderBy(F.desc(F.col("weight") * F.log1p("toxic")), "entry").limit(ENTRIES).collect()}
    plain = Lexicon(weights, frozenset(), (0.0, 0.0, 0.0))

    def phrases(words: list[str]) -> set[str]:
        hits = plain.hits(words)
        return {f"{words[k - 1]} {words[k]}" for k in hits if k} | {f"{words[k]} {words[k + 1]}" for k in hits if k + 1 < len(words)}

    odd = lesson.mapInArrow(_counts(phrases), COUNTS).groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odd = odd.filter((F.col("clean") >= LEAST_DOCS) & (F.col("clean") >= F.col("toxic")))
    exceptions = frozenset(r["entry"] for r in odd.orderBy(F.desc("clean"), "entry").limit(ENTRIES).collect())
    lexicon = Lexicon(weights, exceptions, (0.0, 0.0, 0.0))

    def measure(batch: pa.RecordBatch) -> dict:
        both = [lexicon.measures(fold(t)) for t in batch.column("text").to_pylist()]
        return {"a": [a for a, _ in both], "b": [b for _, b in both], "toxic": batch.column("toxic")}

    points = map_rows(rows.filter(part).select("text", "toxic"), measure, "a double, b double, toxic boolean").collect()
    return Lexicon(weights, exceptions, calibrate(np.array([(r["a"], r["b"], r["toxic"]) for r in points], float).reshape(-1, 3)))


def calibrate(points: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the label on both measures by Newton steps, with a ridge that keeps it finite."""
    x, y = np.column_stack([np.ones(len(points)), points[:, :2]]), points[:, 2]
    line, ridge = np.array([-3.0, 1.0, 1.0]) if not len(points) else np.zeros(3), np.diag([1e-3, 0.1, 0.1])
    for _ in range(50 if len(points) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ line)
        line = line + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(line[0]), float(line[1]), float(line[2])


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, score) for each row of docs(doc_id, text, ...): a probability of being toxic, from the text alone.

    Words are folded (case, accents, look-alike letters, digits and signs for letters), matched against the lexicon in
    one pass, and weighed: the heaviest entry of each word counts unless the word stands in an exception phrase. The
    weight and the weight for the length give the score. Null is the empty text; it and texts without hits get the
    score of weight 0. Whole texts are read at any length. Repeated rows give a row each. Extra columns are ignored; an
    empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "score": [lexicon.score(t) for t in batch.column("text").to_pylist()]}

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), run, "doc_id long, score double")
