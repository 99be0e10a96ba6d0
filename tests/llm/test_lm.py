import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tablesmith.llm import counting, lm

WORDS = [a + b for a in "bcdfgh" for b in "aeiou"]


def brute(train, tests):
    """Scores and base scores by plain counting."""
    split = lambda t: [*(t or "").lower().split(), "</s>"]
    bigrams, unigrams = Counter(), Counter()
    for t in train:
        w = split(t)
        unigrams.update(w)
        bigrams.update(zip(["<s>", *w], w))
    met, after, total = Counter(w for _, w in bigrams), defaultdict(list), Counter()
    for (v, _), c in bigrams.items():
        after[v].append(c)
        total[v] += c
    db = lm.discounts(*(sum(c == k for c in bigrams.values()) for k in range(1, 5)))
    dw = lm.discounts(*(sum(c == k for c in met.values()) for k in range(1, 5)))
    n, size, pairs = sum(unigrams.values()), len(unigrams), sum(met.values())

    def p1(w):
        return (met[w] - dw[min(met[w], 3)]) / pairs + sum(dw[min(c, 3)] for c in met.values()) / pairs / (size + 1)

    def p2(v, w):
        if not total[v]:
            return p1(w)
        c = bigrams[v, w]
        return (c - db[min(c, 3)]) / total[v] + sum(db[min(x, 3)] for x in after[v]) / total[v] * p1(w)

    out = []
    for t in tests:
        w = split(t)
        out.append((len(w), sum(unigrams[x] > 0 for x in w), sum(math.log10((unigrams[x] + 0.5) / (n + 0.5 * (size + 1))) for x in w), sum(math.log10(p2(v, x)) for v, x in zip(["<s>", *w], w))))
    for v in ("<s>", "ba", "ze"):
        assert abs(sum(p2(v, w) for w in unigrams) + p2(v, "never seen") - 1) < 1e-9
    return out


def test_scores_match_plain_counting(spark):
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice(WORDS[: rng.choice([3, 10, 30])]) for _ in range(rng.randint(0, 40)))
    train = [text() for _ in range(200)] + [None, "", "ba " * 900, "be bi " * 70000]
    tests = [text() + rng.choice(["", " zz", " BA\nDe"]) for _ in range(60)] + [None, "", "never seen words"]
    model = lm.train(spark.createDataFrame([(t, 1) for t in train], "text string, part int"))
    assert model.figures["tokens"] == sum(len((t or "").split()) + 1 for t in train)
    got = lm.score(spark.createDataFrame([(i, t, 1) for i, t in enumerate(tests)], "doc_id long, text string, keys int"), model)
    rows = sorted(map(tuple, got.select("doc_id", "n_tokens", "n_known", "base_score", "score").collect()))
    assert np.allclose([r[1:] for r in rows], brute(train, tests))
    assert all(math.isclose(r["perplexity"], 10 ** (-r["score"] / r["n_tokens"])) for r in got.collect())


def test_many_ranges_in_several_shuffles(spark, monkeypatch):
    """As for a table of terabytes: blocks are dealt to few ranges at once, and few arrays are open."""
    assert counting.levels(9) == [9] and counting.levels(10) == [10] and counting.levels(21) == [10, 20, 21]
    rng = random.Random(2)
    train = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 60))) for _ in range(80)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in train], "text string")
    monkeypatch.setattr(counting, "FAN", 3)
    monkeypatch.setattr(lm, "range_bits", lambda docs: 8)
    monkeypatch.setattr(lm, "MAPS", 5)
    assert counting.levels(8) == [3, 6, 8]
    model = lm.train(docs)
    assert model.bits == {"bigram": 8, "context": 6, "word": 6}
    tests = train[:10] + ["never seen"]
    want = brute(train, tests)
    for text, (n, known, _, score) in zip(tests, want, strict=True):
        hashes, first = lm.tokens(pa.array([text or ""], pa.large_string()))
        logs, counts = model.log10(hashes, lm.contexts(hashes, first))
        assert (len(logs), (counts > 0).sum()) == (n, known) and math.isclose(logs.sum(), score)
    assert len(model._arrays) == 5


def test_blocks_of_a_task_are_few():
    """A task hands on a block a range, and what it reads of many tasks as one."""
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    one = (keys, keys, np.ones(5000, np.int64))
    made = list(lm._blocks(iter([one] * 7), 4))
    assert [b.column("part")[0].as_py() for b in made] == list(range(16))
    again = list(lm._resplit(6)(iter(made * 2)))
    assert len(again) == 64 and sum(int(lm._sum(list(lm._unpacked(b)))[2].sum()) for b in again) == 2 * 7 * 5000


def test_ranges_grow_with_the_table(spark, tmp_path, monkeypatch):
    spark.range(20000).selectExpr("id doc_id", "uuid() text").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    few = counting.range_bits(docs)
    monkeypatch.setattr(counting, "RANGE_BYTES", 1000)
    assert counting.range_bits(docs) > few and counting.range_bits(docs, most=5) == 5
    assert counting.range_bits(spark.createDataFrame([(1,)], "a int")) < 24


def test_empty_training(spark):
    model = lm.train(spark.createDataFrame([], "text string"))
    row = lm.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first()
    assert row["n_known"] == 0 and row["score"] == 0
    assert lm.score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0
