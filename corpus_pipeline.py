"""The corpus pipeline: quality rules, line deduplication, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of docs, extra ones included; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm.common import Stash, table
from tablesmith.llm.decontaminate import drop_contaminated
from tablesmith.llm.forest import one_of_each_class
from tablesmith.llm.lines import dedup_lines
from tablesmith.llm.packing import pack
from tablesmith.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have no words and go; so do texts of fewer than 50 words, as the base rules ask. Repeated rows
    stay or go together. A null language is compared with no reference.
    """
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document or line has; those with no word left go.

    Null and empty texts have no lines and stay. Of repeated rows of one doc_id all keep the same lines, as lines are
    told apart by doc_id and place. Rows without a doc_id come after all others.
    """
    return dedup_lines(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of the least doc_id.

    Null and empty texts are equal, so that one of them stays. Rows that repeat a doc_id stay or go together; rows
    without a doc_id stay.
    """
    return one_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Null and empty texts hold none; null items and those of fewer than five words are in no document. Repeated rows stay
    or go together. An empty benchmark keeps all.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths: (doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset, ids_crc32).

    Null is the empty text, which is one piece of the end id. Repeated rows are documents of their own.
    """
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs, stash = table(spark, sf_dir, "documents"), Stash(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has no MinHash, SimHash, connected components or byte-pair encoding; the stages are tested against brute force.
ORACLE_SQL = None
