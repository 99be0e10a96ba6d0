"""Column expressions with the coercions of JavaScript, in which the data's conventions are defined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that String.prototype.trim removes.
WHITE = "\\u0009\\u000A\\u000B\\u000C\\u000D\\u0020\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF"


def js_trim(value: Column) -> Column:
    return F.regexp_replace(value, f"^[{WHITE}]+|[{WHITE}]+$", "")


def js_number(value: Column) -> Column:
    """Number(string) as a double: blank is 0, hexadecimal, octal and binary integers count, other text is null."""
    text = js_trim(value)
    decimal = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text).try_cast("double")
    infinite = F.when(text.rlike(r"^[+-]?Infinity$"), F.regexp_replace(text, r"^\+", "")).try_cast("double")
    based = F.lit(None).cast("double")
    for prefix, digits, base in (("0[xX]", "[0-9a-fA-F]{1,15}", 16), ("0[oO]", "[0-7]{1,20}", 8), ("0[bB]", "[01]{1,60}", 2)):
        based = F.when(text.rlike(f"^{prefix}{digits}$"), F.conv(F.substring(text, 3, 64), base, 10).try_cast("double")).otherwise(based)
    return F.when(text == "", F.lit(0.0)).otherwise(F.coalesce(decimal, infinite, based))


def js_parse_int(value: Column) -> Column:
    """parseInt(string, 10): the whole number that the text begins with, else null."""
    return F.nullif(F.regexp_extract(value, f"^[{WHITE}]*([+-]?\\d+)", 1), F.lit("")).try_cast("long")


def js_parse_float(value: Column) -> Column:
    """parseFloat(string): the number that the text begins with, else null."""
    return F.nullif(F.regexp_extract(value, f"^[{WHITE}]*([+-]?(?:\\d+\\.?\\d*|\\.\\d+)(?:[eE][+-]?\\d+)?)", 1), F.lit("")).try_cast("double")


def index_key(value: Column) -> Column:
    """Whether an object lists this key among its leading keys, in ascending order of number."""
    return value.rlike(r"^(0|[1-9]\d{0,9})$")


def key_order(value: Column, place: Column) -> list[Column]:
    """Sort columns that give an object's order of keys: numbers ascending, then others as they were put in."""
    number = F.when(index_key(value), value).try_cast("long")
    return [number.asc_nulls_last(), place.asc()]
