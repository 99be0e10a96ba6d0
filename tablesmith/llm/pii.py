"""Personal data: base patterns as seeds, and contextual patterns bootstrapped from them."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import Stash, map_rows, text_of
from tablesmith.llm.findings import FINDING, ordered
from tablesmith.llm.sieve import Sieve

KINDS = ("email", "ip", "card", "phone")
#: Trusted values that a pattern needs, prior mass against rare patterns, and the confidence that counts.
LEAST_SEEDS, PRIOR, CONFIDENT = 5, 2.0, 0.8
#: Rounds end when they make no pattern good and good patterns' scores grow by less than this in all.
SETTLED = 0.001
#: Letters of a word of a pattern; what stands between spaces and is longer is no word.
WORD = 64
#: Rows that a pattern is joined by, as one pattern may surround most instances.
SALTS = 16

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Identifiers that the base patterns may miss: runs of digits and separators, or with an at sign or a spelled-out one (of names and labels of an address's greatest lengths).
_CANDIDATE = re.compile(r"[0-9(][0-9().\x20/-]{5,}[0-9]|[A-Za-z0-9._%+-]{2,64}(?:\x20?[(\[]at[)\]]\x20?|@)[A-Za-z0-9-]{2,63}(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]{2,63})*", re.A)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each at sign outwards in linear time."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    """Four dotted numbers, taken four by four from the left of each dotted run; parts over 255 drop the match."""
    found = []
    for m in _DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            parts = [(p.start() + m.start(), p.end() + m.start(), p[0]) for p in re.finditer("[0-9]+", m[0])]
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for _, _, p in four):
                    found.append((four[0][0], four[3][1]))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15] if "+" in text else []


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(kind, s, e) for kind, find in zip(KINDS, (emails, ips, cards, phones)) for s, e in find(text)]


class Words:
    """The words of a text, found once for all of its instances."""

    def __init__(self, text: str):
        spans = [m.span() for m in _WORD.finditer(text)]
        self.text, self.starts, self.ends = text, [s for s, _ in spans], [e for _, e in spans]

    def word(self, start: int, end: int) -> str:
        return self.text[start:end].lower().strip(".,;:!?\"'()[]") if end - start <= WORD else ""

    def patterns(self, start: int, end: int) -> list[str]:
        """Lexical patterns of an instance: the word and the two words before it, the two after it, and one of either side.

        What is left of a word that the instance begins or ends in is a word.
        """
        before, after = bisect_left(self.starts, start), bisect_right(self.ends, end)
        left = [self.word(self.starts[k], min(self.ends[k], start)) for k in range(max(0, before - 2), before)]
        right = [self.word(max(self.starts[k], end), self.ends[k]) for k in range(after, min(len(self.ends), after + 2))]
        out = []
        if left and left[-1]:
            out.append(f"L {left[-1]}")
            if len(left) > 1 and left[0]:
                out.append(f"LL {left[0]} {left[-1]}")
            if right and right[0]:
                out.append(f"LR {left[-1]} _ {right[0]}")
        if len(right) > 1 and right[0] and right[1]:
            out.append(f"RR {right[0]} {right[1]}")
        return out


def kinds_of(value: str) -> list[str]:
    """The kinds whose form an identifier-like run can take."""
    digits = sum("0" <= c <= "9" for c in value)
    if "@" in value or "at" in value.lower():
        return ["email"]
    return [k for k, good in (("ip", value.count(".") == 3 and digits <= 12), ("card", 12 <= digits <= 19), ("phone", 7 <= digits <= 15)) if good]


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Spans of identifier-like runs that no base span touches."""
    if not taken and not any(c in text for c in "0123456789@") and "at)" not in text and "at]" not in text:
        return []
    low = np.array(sorted(s for _, s, _ in taken), np.int64)
    high = np.maximum.accumulate(np.array([e for _, s, e in sorted(taken, key=lambda x: x[1])], np.int64)) if taken else low
    out = []
    for m in _CANDIDATE.finditer(text):
        k = np.searchsorted(low, m.end())
        if not k or high[k - 1] <= m.start():
            if sum("0" <= c <= "9" for c in m[0]) >= 4 or not "0" <= m[0][0] <= "9" and m[0][0] != "(":
                out.append(m.span())
    return out


def extract(docs: DataFrame) -> DataFrame:
    """(doc_id, findings) for each row of docs(doc_id, text, ...).

    Base patterns find seeds. Every seed, and every identifier-like run that no seed touches, is an instance whose
    surrounding words are patterns. On the graph of patterns and instances Spark scores both in turn. A pattern of a kind
    has the trust of its different values as its score, of all values of the kind's form and PRIOR more; seeds have a
    trust of 1. A pattern is good if that is CONFIDENT or more and LEAST_SEEDS of its values are trusted. The values that a
    good pattern surrounds are trusted by its score, wherever they stand, and so induce further patterns, until a round
    makes no pattern good and adds less than SETTLED to all scores together; scores only grow. What good patterns surround is added to the base findings with base = false. Findings are
    ordered by start, then kind.

    Patterns that have fewer than LEAST_SEEDS different values can't become good and leave the graph first. All rounds
    aggregate on the map side before they shuffle, and patterns are joined by salted keys, so that a very common pattern is
    spread over tasks. Null is the empty text, without findings. Whole texts are read at any length. Repeated rows give a
    row each. Extra columns are ignored; an empty table gives no rows.
    """
    stash = Stash(docs.sparkSession, "pii")
    found = stash(map_rows(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")),
        _first_pass,
        f"row long, doc_id long, findings array<{FINDING}>, instances array<struct<kind:string,value:string,start:long,end:long,seed:boolean,patterns:array<string>>>",
    ))
    instances = found.select("row", F.inline("instances"))
    every = instances.select("kind", "value", "seed", F.explode("patterns").alias("pattern")).groupBy("kind", "pattern", "value").agg(F.max("seed").alias("seed"))
    every = stash(every)
    common = stash(every.groupBy("kind", "pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_SEEDS))
    edges = stash(_salted(every, common, "value").select("kind", "pattern", "value", "seed"))
    trusted = edges.filter("seed").select("kind", "value", F.lit(1.0).alias("trust")).distinct()
    good, known = None, (0, 0.0)
    while True:
        held = edges.join(stash(trusted), ["kind", "value"]).groupBy("kind", "pattern").agg(F.sum("trust").alias("mass"), F.count("*").alias("values"))
        score = F.col("mass") / (F.col("n") + PRIOR)
        better = held.filter(F.col("values") >= LEAST_SEEDS).join(common, ["kind", "pattern"]).select("kind", "pattern", score.alias("score")).filter(F.col("score") >= CONFIDENT)
        better = stash(better)
        now = better.agg(F.count("*"), F.coalesce(F.sum("score"), F.lit(0.0))).first()
        if now[0] == known[0] and now[1] < known[1] + SETTLED:
            break
        good, known = better, now
        by_patterns = _salted(edges.filter("not seed"), good, "value").groupBy("kind", "value").agg(F.max("score").alias("trust"))
        trusted = edges.filter("seed").select("kind", "value", F.lit(1.0).alias("trust")).distinct().unionByName(by_patterns)
        trusted = trusted.groupBy("kind", "value").agg(F.max("trust").alias("trust"))
    if good is None:
        return found.select("doc_id", "findings")
    places = instances.filter("not seed").select("row", "kind", "start", "end", "value", F.explode("patterns").alias("pattern"))
    hits = _salted(places, good, "row").select("row", "kind", "start", "end", "value").distinct()
    added = hits.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", F.lit(False).alias("base"), F.lit("context").alias("via"), "value")).alias("added"))
    both = F.concat("findings", F.coalesce("added", F.array().cast(f"array<{FINDING}>")))
    rank = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(both, lambda f: F.struct(f["start"], F.array_position(rank, f["kind"]).alias("rank"), f["end"], f.alias("finding")))
    return found.join(added, "row", "left").select("doc_id", F.transform(F.array_sort(keyed), lambda x: x["finding"]).cast(f"array<{FINDING}>").alias("findings"))


def _salted(rows: DataFrame, patterns: DataFrame, spread: str) -> DataFrame:
    """rows joined with stashed (kind, pattern, ...): only rows that may have a partner, a pattern's spread over SALTS keys."""
    key = F.xxhash64("kind", "pattern").alias("key")
    keyed = patterns.select(key)
    keyed.stash_path = patterns.stash_path
    some = Sieve(keyed, "key").keep(rows.select("*", key), "key").drop("key")
    salted = patterns.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return some.withColumn("salt", F.pmod(F.xxhash64(spread, F.lit("salt")), F.lit(SALTS)).cast("int")).join(salted, ["kind", "pattern", "salt"])


def _first_pass(batch: pa.RecordBatch) -> dict:
    findings, instances = [], []
    for text in batch.column("text").to_pylist():
        base = base_spans(text)
        findings.append(ordered([{"kind": k, "start": s, "end": e, "base": True, "via": "base", "value": text[s:e]} for k, s, e in base], KINDS))
        runs = [(k, s, e) for s, e in candidates(text, base) for k in kinds_of(text[s:e])]
        words = Words(text) if base or runs else None
        instances.append([{"kind": k, "value": text[s:e], "start": s, "end": e, "seed": seed, "patterns": words.patterns(s, e)} for seed, some in ((True, base), (False, runs)) for k, s, e in some])
    return {"row": batch.column("row"), "doc_id": batch.column("doc_id"), "findings": findings, "instances": instances}
