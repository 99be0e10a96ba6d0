"""Quality rules: distribution divergence from language references, beside four simple counts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import map_rows, small, text_of
from tablesmith.llm.counting import BLOCKS, U, Tally, merged, range_bits, tally
from tablesmith.llm.words import chunks, mix, ngram_hashes, spans, utf8, word_hashes

#: Words of a reference histogram; the rest of a text's words is one more bin.
COMMON_WORDS = 100
#: Guards: characters and words that a text needs for a verdict, and words that a language needs for a reference.
LEAST_CHARS, LEAST_WORDS, LEAST_REFERENCE = 100, 50, 2000
#: Jensen-Shannon distances (0 to 1) from which a text is rejected.
CHARS_APART, WORDS_APART = 0.3, 0.5
#: A language tag, with parts for regions or scripts that don't count: at most 26**2 + 26**3 languages, which bounds the references.
LANGUAGE = "^([A-Za-z]{2,3})(?:[-_].*)?$"


@lru_cache(maxsize=1 << 16)
def language(tag: str | None) -> str:
    """The language of a tag: pt of pt-BR, en of EN; none of what is no tag."""
    m = re.match(LANGUAGE, tag or "", re.S)
    return m[1].lower() if m else ""


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: Character classes by a character's first byte: lower, upper, digit, space, punctuation, symbol, control, letters beyond ASCII in two bytes, and characters of three or four bytes.
CLASSES = 9
_CLASS = np.full(256, 8, np.int64)
_CLASS[0xC2:0xE0] = 7
_CLASS[:128] = 5
_CLASS[:32] = 6
_CLASS[127] = 6
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[list(b".,;:!?'\"()-")] = 4


def _lower(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


def class_counts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Characters of each class in each text."""
    lead = (raw & 0xC0) != 0x80
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[lead]
    return np.bincount(owner * CLASSES + _CLASS[raw[lead]], minlength=(len(at) - 1) * CLASSES).reshape(-1, CLASSES)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of histograms along the last axis; 0 where either is empty."""
    total = p.sum(-1, keepdims=True), q.sum(-1, keepdims=True)
    p, q = p / np.maximum(total[0], 1), q / np.maximum(total[1], 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        side = [np.where(x > 0, x * np.log2(np.where(m > 0, x / m, 1)), 0).sum(-1) for x in (p, q)]
    return np.where((total[0] * total[1])[..., 0] > 0, np.sqrt(np.maximum(0, (side[0] + side[1]) / 2)), 0)


def _class_keys() -> np.ndarray:
    """Keys under which class counts travel; those of words are hashes as well, so a meeting is as unlikely as any."""
    return mix(np.arange(1, CLASSES + 1, dtype=U) * U(0xD1B54A32D192ED03))


def references(docs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By language: character class counts, and the sorted hashes and counts of its commonest words, the rest last.

    Counted over all words of all documents. Only tags of LANGUAGE with LEAST_REFERENCE words or more count, so what
    reaches the driver is bounded by 18,252 languages of about 1.7 kB.
    """
    bits = range_bits(docs, most=14)  # of different words, which are far fewer than words: some million a range at 100 TB
    keys_of_classes = _class_keys()

    def fill(batch: pa.RecordBatch, held: Tally) -> None:
        text, langs = batch.column("text"), np.array([language(x) for x in batch.column("lang").to_pylist()], object)
        for i, j in chunks(utf8(text)[1]):
            raw, at = utf8(text[i:j])
            classes = class_counts(raw, at)
            starts, ends, first = spans(raw, at)
            words, owner = word_hashes(_lower(raw), starts, ends), np.repeat(np.arange(j - i), np.diff(first))
            for lang in set(langs[i:j]):
                own = langs[i:j] == lang
                held.add(lang, words[own[owner]])
                held.add(lang, keys_of_classes, classes[own].sum(0).astype(np.int64))

    def commonest(table: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("lang", "keys", "counts", "classes", "words")}
        for lang, (keys, counts) in merged(table).items():
            is_class = np.isin(keys, keys_of_classes)
            classes = np.array([counts[keys == k].sum() for k in keys_of_classes])
            keys, counts = keys[~is_class], counts[~is_class]
            top = np.lexsort((keys, -counts))[:COMMON_WORDS]
            for k, v in zip(out, (lang, keys[top].view(np.int64).tolist(), counts[top].tolist(), classes.tolist(), int(counts.sum()))):
                out[k].append(v)
        return pa.table(out, _TOPS)

    def whole(table: pa.Table) -> pa.Table:
        """The tops of all ranges of one language: at most 2**14 ranges of COMMON_WORDS words."""
        keys, counts = (np.concatenate(table.column(c).to_pylist()).astype(np.int64) for c in ("keys", "counts"))
        top = np.lexsort((keys.view(U), -counts))[:COMMON_WORDS]
        classes = np.sum(table.column("classes").to_pylist(), axis=0)
        return pa.table([[table.column("lang")[0].as_py()], [keys[top].tolist()], [counts[top].tolist()], [classes.tolist()], [sum(table.column("words").to_pylist())]], _TOPS)

    tagged = docs.select(text_of().alias("text"), "lang").filter(F.col("lang").rlike(LANGUAGE))
    columns = "lang string, keys array<long>, counts array<long>, classes array<long>, words long"
    parts = tagged.mapInArrow(tally(fill, bits), BLOCKS).groupBy("part").applyInArrow(commonest, columns)
    out = {}
    for r in parts.groupBy("lang").applyInArrow(whole, columns).filter(F.col("words") >= LEAST_REFERENCE).collect():
        keys = np.array(r["keys"], np.int64).view(U)
        order = np.argsort(keys)
        counts = np.array(r["counts"], np.int64)[order]
        out[r["lang"]] = np.array(r["classes"]), keys[order], np.append(counts, r["words"] - counts.sum())
    return out


_TOPS = pa.schema([("lang", pa.string()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("classes", pa.list_(pa.int64())), ("words", pa.int64())])


def _measure(refs: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    def run(batch: pa.RecordBatch) -> dict:
        columns: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_repeat_words", "n_chars", "chars_apart", "words_apart")}
        text, langs = batch.column("text"), np.array([language(x) for x in batch.column("lang").to_pylist()], object)
        for i, j in chunks(utf8(text)[1]):
            raw, at = utf8(text[i:j])
            starts, ends, first = spans(raw, at)
            n = np.diff(first)
            owner = np.repeat(np.arange(j - i), n)
            lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            symbols = np.concatenate([[0], np.cumsum(_SYMBOL[raw])])
            classes = class_counts(raw, at)
            columns["n_words"].append(n)
            columns["word_chars"].append(np.bincount(owner, lead[ends] - lead[starts], j - i).astype(np.int64))
            columns["n_symbols"].append(symbols[at[1:]] - symbols[at[:-1]])
            columns["n_repeat_words"].append(np.bincount(owner[_repeated(word_hashes(raw, starts, ends), owner)], minlength=j - i))
            columns["n_chars"].append(lead[at[1:]] - lead[at[:-1]])
            chars, words = np.zeros(j - i), np.zeros(j - i)
            hashes = word_hashes(_lower(raw), starts, ends)
            for lang in set(langs[i:j]):
                if lang in refs:
                    own = np.flatnonzero(langs[i:j] == lang)
                    ref_classes, keys, ref_words = refs[lang]
                    chars[own] = distance(classes[own].astype(float), ref_classes.astype(float))
                    place = np.full(j - i, -1)
                    place[own] = np.arange(len(own))
                    mine = place[owner] >= 0
                    where = np.searchsorted(keys, hashes[mine])
                    bins = np.where(keys[np.minimum(where, len(keys) - 1)] == hashes[mine], where, len(keys))
                    hist = np.bincount(place[owner[mine]] * (len(keys) + 1) + bins, minlength=len(own) * (len(keys) + 1))
                    words[own] = distance(hist.reshape(len(own), -1).astype(float), ref_words.astype(float))
            columns["chars_apart"].append(chars)
            columns["words_apart"].append(words)
        out = {k: pa.array(np.concatenate(v)) for k, v in columns.items()}
        out["n_dup_lines"] = pa.array([_dup_lines(t) for t in text.to_pylist()], pa.int64())
        n, repeated, chars, words = (np.asarray(out[k]) for k in ("n_words", "n_repeat_words", "chars_apart", "words_apart"))
        failed = (n < 50) | (100 * repeated > 50 * n)
        apart = ((np.asarray(out["n_chars"]) >= LEAST_CHARS) & (chars >= CHARS_APART)) | ((n >= LEAST_WORDS) & (words >= WORDS_APART))
        return out | {"doc_id": batch.column("doc_id"), "base_failed": pa.array(failed), "kept": pa.array(~failed & ~apart)}

    return run


def _repeated(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Positions of words in three-word windows that their text has twice or more."""
    windows = ngram_hashes(words, 3)
    if not len(windows):
        return np.zeros(0, int)
    inside = np.flatnonzero(owner[: len(windows)] == owner[2:])
    keys = mix(windows[inside] ^ (owner[inside].astype(U) * U(0x9E3779B97F4A7C15)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = inside[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[twice + k] = True
    return np.flatnonzero(covered)


def _dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip("\t\n\x0b\x0c\r ")]
    return len(lines) - len(set(lines))


def quality(docs: DataFrame) -> DataFrame:
    """One row for each row of docs(doc_id, text, lang, ...): counts, distances and the verdict `kept`.

    Base: words are `[^\\x20\\x09-\\x0D]+`; base_failed if there are fewer than 50, or more than half stand in
    three-word windows that the text has twice or more. Method: the histograms of character classes and of the
    language's 100 commonest words (lower-cased A-Z) are compared with those of all documents of that language by
    Jensen-Shannon distance. A text is rejected if its characters are CHARS_APART or more and it has LEAST_CHARS
    characters, or if its words are WORDS_APART or more and it has LEAST_WORDS words. Tags are read as their language
    (pt-BR as pt, EN as en). Where the language is null, no two- or three-letter tag, or has fewer than LEAST_REFERENCE words in all documents, distances are 0.

    Null is the empty text, which fails the base. Very long texts are measured whole. Repeated rows give a row each.
    Extra columns are ignored; an empty table gives no rows.
    """
    refs = references(docs)
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_chars long, chars_apart double, words_apart double, base_failed boolean, kept boolean"
    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.coalesce("lang", F.lit("")).alias("lang")), _measure(refs), schema)


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of docs(doc_id, text, lang, ...) that quality() keeps, with the columns of docs: a filter without a join.

    Null and empty texts go. Repeated rows stay or go together. An empty table gives an empty one.
    """
    measure = _measure(references(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            plain = {"doc_id": batch.column("doc_id"), "text": batch.column("text").fill_null(""), "lang": batch.column("lang").fill_null("")}
            yield batch.filter(measure(pa.RecordBatch.from_pydict(plain))["kept"])

    return docs.mapInArrow(run, docs.schema)
