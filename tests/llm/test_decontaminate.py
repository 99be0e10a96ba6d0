import random

import pytest

from tablesmith.llm import decontaminate

WORDS = [a + b + c for a in "bcdfg" for b in "aeiou" for c in ("n", "rst", "llow", "m", "ts")]


def brute(text, item):
    w, v = text.lower().split(), item.lower().split()

    def weigh(words):
        return {tuple(words[k : k + 5]): min(8, max(1, sum(map(len, words[k : k + 5])) // 5)) for k in range(len(words) - 4)}

    target, best = weigh(v), 0.0
    for s in range(max(1, len(w) - 4)):
        window = weigh(w[s : s + len(v)])
        both = sum(x for k, x in target.items() if k in window)
        total = sum(window.values()) + sum(target.values()) - both
        best = max(best, both / total if total else 0)
    return best


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(11)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([3, 5, 6, 9, 15, 24, 40, 58, 130])))) for i in range(40)]
    docs = []
    for d in range(160):
        words = [rng.choice(WORDS) for _ in range(rng.randint(0, 300))]
        passage = items[d % 40][1].split()
        if d % 4 == 0:
            if d % 8 == 0 and len(passage) > 30:
                passage[10] = "edited"
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((d, " ".join(words), "x"))
    items.append((40, " ".join(f"ñandú{k} éa" for k in range(20))))
    return docs + [(900, None, "x"), (901, "", "x"), (902, items[7][1], "x"), (902, items[7][1], "x"), (903, "x " + " ".join(f"ñandú{k} éa" for k in range(20)).upper(), "x")], items


def test_exact_and_near_passages_are_found(spark, planted):
    docs, items = planted
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, i): s for d, text, _ in docs for i, item in items if text and (s := brute(text, item)) >= 0.8}
    assert len(want) > 30 and set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    kept = decontaminate.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {d for d, _, _ in docs} - {d for d, _ in want}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, items).count() == 0
    assert decontaminate.contaminated(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), items).count() == 0
