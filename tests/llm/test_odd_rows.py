"""Nulls in every column, repeated rows, ties and columns whose names clash: no operator fails, all rows come back."""

import pytest
from pyspark.sql import functions as F

from tablesmith.llm import decontaminate, fill_middle, forest, licenses, lines, lm, packing, pii, quality, secrets, spelling, style_tree, toxicity

CLASH = "h long, k1 string, keys int, bands string, family string, label double, words int, hashes string, rep_id int, _maybe string, part int, tag string, value string, start string, findings int, score string, item_id string, `__gone` int"
ROWS = [(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (None, "alpha beta gamma delta epsilon zeta"), (None, None), (3, ""), (4, " \n\t"), (5, "word " * 30000), (6, "All rights reserved."), (-7, "token = 'abcdefghijkl'\nme@here.org")]


@pytest.fixture(scope="module")
def docs(spark):
    n = len(CLASH.split(","))
    rows = [(d, t, None, None, None, *[None] * n) for d, t in ROWS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=str)


def test_one_row_for_each_row(spark, docs):
    want = sorted((d for d, _ in ROWS), key=str)
    model = lm.train(docs)
    lexicon = toxicity.learn(docs, spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int"))
    for made in (fill_middle.transform(docs), toxicity.score(docs, lexicon), forest.jaccard_join(docs), lm.score(docs, model), secrets.scan(docs), quality.quality(docs), pii.extract(docs)):
        assert ids(made) == want
    assert sum(r["length"] for r in packing.pack(docs).collect()) > 30000


def test_filters_keep_columns(spark, docs):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (2, None), (None, "never here at all today")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()} == {(1, 1), (None, 1)}
    for made in (decontaminate.drop_contaminated(docs, items), forest.one_of_each_class(docs), lines.dedup_lines(docs), quality.keep_good(docs)):
        assert made.columns == docs.columns and made.schema.simpleString() == docs.schema.simpleString()
        assert made.count() <= len(ROWS)
    kept = {(r["doc_id"], r["text"]) for r in lines.dedup_lines(docs).collect()}
    assert kept == {(d, t) for d, t in ROWS}
    assert [(r["doc_id"], r["license"]) for r in licenses.scan(docs).collect()] == [(6, "Proprietary")]
    assert lines.line_classes(docs).filter(F.col("doc_id") == 6).count() == 1


def test_words_and_pages_of_odd_rows(spark, docs):
    assert sorted((r["word"], r["n"]) for r in spelling.variants(docs.withColumn("text", F.concat("text", F.lit(" repeatedly REPEATEDLY")))).collect()) == sorted(brute_counts())
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.concat(F.lit("<p>"), "text").alias("html"), *[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"])
    got = style_tree.extract(pages)
    assert got.count() == len(ROWS) and [c for c in got.columns if c in ("n_chars", "text")] == ["text", "n_chars"]
    assert {(r["page_id"], r["text"]) for r in got.collect()} == {(d, " ".join((t or "").split())) for d, t in ROWS}


def brute_counts():
    from tests.llm.test_spelling import brute

    return {(w, n) for w, n, *_ in brute([(d, None if t is None else t + " repeatedly REPEATEDLY") for d, t in ROWS])}
