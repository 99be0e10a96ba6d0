"""Legends of tables: codes in brackets that stand for promotion or relegation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A legend's entries: one code, or several parted by commas, slashes, "and" or "or".
ONE_CODE, CODES = r"\(([A-Za-z0-9+]+)\)\s*([^();]+)", r"\(([^)]+)\)\s*([^();]+)"
PROMOTED, RELEGATED = "promot|play-?off", "relegat|demot"


def split_codes(text: Column) -> Column:
    """Codes of a text in brackets, upper case, other characters than letters, digits and + dropped."""
    parts = F.split(text, r"(?i)[,/]|\band\b|\bor\b")
    return F.filter(F.transform(parts, lambda p: F.upper(F.regexp_replace(p, "[^A-Za-z0-9+]", ""))), lambda p: p != "")


def legend(text: Column, several: bool = False) -> Column:
    """array<struct<codes, promoted, relegated>> of a legend's text; several: entries may have more than one code."""
    pattern = F.lit(CODES if several else ONE_CODE)
    tidy = F.regexp_replace(text, r"\s+", " ")
    pairs = F.arrays_zip(F.regexp_extract_all(tidy, pattern, 1).alias("code"), F.regexp_extract_all(tidy, pattern, 2).alias("meaning"))
    meaning = lambda p: F.lower(p["meaning"])
    codes = lambda p: split_codes(p["code"]) if several else F.array(F.upper(p["code"]))
    return F.transform(pairs, lambda p: F.struct(codes(p).alias("codes"), meaning(p).rlike(PROMOTED).alias("promoted"), meaning(p).rlike(RELEGATED).alias("relegated")))


def legend_flags(text: Column, symbols: Column, several: bool = False) -> Column:
    """struct<promoted, relegated>: whether the legend says so of any of the symbols."""
    entries = F.filter(legend(text, several), lambda e: F.arrays_overlap(e["codes"], symbols))
    return F.struct(F.exists(entries, lambda e: e["promoted"]).alias("promoted"), F.exists(entries, lambda e: e["relegated"]).alias("relegated"))
