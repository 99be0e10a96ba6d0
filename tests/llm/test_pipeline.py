import random

import pytest

import corpus_pipeline
from tablesmith.llm.queries import OPERATORS

VOWELS, CONSONANTS = "aeiou", "bcdfglmnprst"


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else "".join(rng.choice(CONSONANTS) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, folder = random.Random(12), tmp_path_factory.mktemp("sf")
    docs = [[k, "\n".join(sentence(rng, rng.randint(30, 60)) for _ in range(rng.randint(2, 5))), "en", "s", 0] for k in range(80)]
    items = [(k, sentence(rng, 40)) for k in range(5)]
    docs[10][1] += "\n" + items[2][1]
    words = docs[20][1].split(" ")
    words[len(words) // 2] = "changed"
    docs += [[100, docs[5][1], "en", "s", 0], [101, " ".join(words), "en", "s", 0], [102, docs[6][1].upper().replace(" ", "!! "), "en", "s", 0], [103, None, "en", "s", 0], [104, docs[7][1].split("\n")[0] + "\n" + sentence(rng, 70), "en", "s", 0]]
    rows = [(d, t, l, s, len(t or "")) for d, t, l, s, _ in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), {d: t for d, t, *_ in docs}, dict(items)


def test_each_stage_takes_effect(spark, tables):
    folder, texts, items = tables
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "packing"]
    docs, at = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
        at[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(texts) - set(at["quality_rules"]) == {102, 103}
    lines = at["line_dedup"]
    assert set(at["quality_rules"]) - set(lines) == {100, 101} - set(lines) and 100 not in lines
    assert lines[104] == texts[104].split("\n")[1] and all(lines[d] == texts[d] for d in range(80))
    assert set(at["jaccard_join"]) == set(lines) - ({101} & set(lines)) or 101 not in lines
    assert set(at["jaccard_join"]) - set(at["decontamination"]) == {10}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(at["decontamination"])
    assert sum(r["length"] for r in rows) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values())


def test_stages_take_empty_tables(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables[0]).count() == 0


def test_a_query_for_each_operator():
    assert [int(q[2:].split("_")[0]) for q in OPERATORS] == list(range(1, 14))
