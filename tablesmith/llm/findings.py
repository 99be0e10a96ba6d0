"""Found spans as rows of an array, and digests of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Of one span: code points of the whole text, end exclusive; base: found by a base pattern in the text itself.
FINDING = "struct<kind:string,start:long,end:long,base:boolean,via:string,value:string>"


def ordered(spans: list[dict], kinds: tuple[str, ...]) -> list[dict]:
    return sorted(spans, key=lambda f: (f["start"], kinds.index(f["kind"]), f["end"]))


def line(findings: Column) -> Column:
    """kind:start:end of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def base_of(findings: Column) -> Column:
    return F.filter(findings, lambda f: f["base"])


def count_of(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["base"] & (f["kind"] == kind))).cast("long")


def digest(findings: str, kinds: tuple[str, ...]) -> list[Column]:
    """Counts of base findings of each kind, their SHA-256, the line of all findings, and their number."""
    column = F.col(findings)
    counts = [count_of(column, kind).alias(f"n_{kind}") for kind in kinds]
    return [*counts, F.sha2(line(base_of(column)), 256).alias("base_sha256"), line(column).alias("spans"), F.size(column).cast("long").alias("n_spans")]
