"""The registered queries of this subpackage: one for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm import decontaminate, fill_middle, forest, licenses, lines, lm, packing, pii, quality, secrets, spelling, style_tree, toxicity
from tablesmith.llm.common import table
from tablesmith.llm.findings import digest
from tablesmith.llm.oracles import ORACLES, bases


def _remainder(divisor: int, value: int) -> Column:
    """Whether crc32 of doc_id as text has this remainder; no for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == value, F.lit(False))


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _remainder(4, 2)
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _remainder(5, 1)
    model = lm.train(docs.filter(~held_out))
    scored = lm.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.figures["tokens"]).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *digest("findings", secrets.KINDS))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *digest("findings", pii.KINDS))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), restored.alias("restored_sha256"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_language_model": op5_language_model,
    "op6_secrets": op6_secrets,
    "op7_packing": op7_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_fill_middle": op11_fill_middle,
    "op12_html_text": op12_html_text,
    "op13_spelling": op13_spelling,
}
#: The operators' queries, and those columns of theirs that SQL can express, which have an oracle.
QUERIES = OPERATORS | bases(OPERATORS)
__all__ = ["OPERATORS", "ORACLES", "QUERIES"]
