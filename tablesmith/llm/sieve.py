"""A Bloom filter of bounded size as a table of bit words: most rows that a join would drop never reach its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key; and the least and most bits of a filter, as powers of two: 8 MB of bits are all that is ever broadcast, however many keys there are.
EACH, LEAST, MOST = 16, 16, 26
#: Bits, as a power of two, of a filter of keys that would have to be computed to be counted.
UNKNOWN = 24
#: The column that split() adds.
MAYBE = "__sieve_maybe"


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0x51E7E)), F.lit(1 << bits))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


class Sieve:
    """Of the keys in a table's column. Keys of the table always pass, others seldom while 2**MOST bits have EACH for a key.

    Stashed tables, which Spark counts from their files' footers, get a filter of a size for their rows.
    """

    def __init__(self, keys: DataFrame, column: str):
        rows = keys.count() if hasattr(keys, "stash_path") else None
        self.bits = UNKNOWN if rows is None else min(MOST, max(LEAST, (EACH * rows).bit_length()))
        place = keys.select(_place(F.col(column), self.bits).alias("place"))
        words = place.groupBy(F.expr("place div 64").alias("__sieve_word")).agg(F.bit_or(_bit(F.col("place"))).alias("__sieve_bits"))
        self.words = F.broadcast(words)

    def split(self, df: DataFrame, column: str) -> DataFrame:
        """df with a boolean MAYBE: false where the keys surely lack the row's value."""
        placed = df.withColumn("__sieve_place", _place(F.col(column), self.bits)).withColumn("__sieve_word", F.expr("__sieve_place div 64"))
        maybe = F.coalesce(F.col("__sieve_bits").bitwiseAND(_bit(F.col("__sieve_place"))) != 0, F.lit(False))
        return placed.join(self.words, "__sieve_word", "left").select(*df.columns, maybe.alias(MAYBE))

    def keep(self, df: DataFrame, column: str) -> DataFrame:
        """Rows of df that the keys may hold."""
        placed = df.withColumn("__sieve_place", _place(F.col(column), self.bits)).withColumn("__sieve_word", F.expr("__sieve_place div 64"))
        return placed.join(self.words, "__sieve_word").filter(F.col("__sieve_bits").bitwiseAND(_bit(F.col("__sieve_place"))) != 0).select(df.columns)


def packed(df: DataFrame, column: str) -> DataFrame:
    """(key, row): a column and whole rows of df, so that no name of df can clash with one of a plan's own."""
    return df.select(F.col(f"`{column}`").alias("key"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def without(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of df whose value the keys lack; only rows that the filter can't clear are joined and shuffled. Null values stay."""
    listed = keys.select(F.col(column).alias("key")).distinct()
    both = Sieve(listed, "key").split(packed(df, column), "key")
    clear = both.filter(f"not {MAYBE}").select("row.*")
    return clear.unionAll(both.filter(MAYBE).join(listed, "key", "left_anti").select("row.*"))
