import random

import pytest
from pyspark.sql import functions as F

from tablesmith.llm import lines
from tests.llm.test_lines import WORDS, brute


def copies(count, seed):
    """One line's near copies, some of them too far from all others, and a few copies of one of these."""
    rng = random.Random(seed)
    base = [rng.choice(WORDS) for _ in range(40)]

    def changed(words, changes):
        words = list(words)
        for k in rng.sample(range(len(words)), changes):
            words[k] = "".join(rng.choice("jkqvwxyz") for _ in range(5)) if rng.random() < 0.7 else rng.choice(WORDS)
        return words

    far = changed(base, 9)
    return [" ".join(changed(far, 1) if k % 29 == 0 else changed(base, rng.choice([1, 2, 3, 4, 5, 6, 7]))) for k in range(count)]


@pytest.mark.parametrize("count, seed", [(150, 1), (260, 2)])
def test_crowds_of_near_copies_meet_in_few_pairs(spark, monkeypatch, count, seed):
    looked, links = [], []
    likely, crowd_links = lines._likely, getattr(lines, "_crowd_links", None)

    def counted(dealt, *args):
        sizes = dealt.groupBy("band", "i", "j").count()
        looked.append(sizes.agg(F.sum(F.col("count") * F.col("count"))).first()[0] or 0)
        return likely(dealt, *args)

    def crowds(*args):
        met, sure = crowd_links(*args)
        links.append(met.count())
        return met, sure

    monkeypatch.setattr(lines, "_likely", counted)
    monkeypatch.setattr(lines, "_crowd_links", crowds, raising=False)
    texts = list(enumerate(copies(count, seed)))
    rows = lines.line_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in rows} == brute(texts)
    # All pairs of a band would be at least this many.
    assert looked[0] < count * count / 4
    assert sum(links) < count * 10


def test_crowd_links_miss_no_similar_pair(spark):
    # Every line a component of its own: whatever the majority is, all similar pairs are linked or surely connected.
    for texts in (copies(70, 3) + copies(50, 4), ["ab" * n for n in range(20, 60)] + [f"{k} other words {k * 7919}" for k in range(30)]):
        table = spark.createDataFrame([(t,) for t in sorted(set(texts))], "line string").withColumn("h", F.xxhash64("line"))
        stash = lines.Stash(spark, "test")
        table = stash(table)
        c = table.count()
        crowd = stash(table.select(F.lit(1).cast("long").alias("centre"), F.lit(c).alias("c"), F.lit(0).alias("chunk"), "h", F.col("h").alias("comp")))
        met, sure = lines._crowd_links(crowd, table.select("h", "line"), stash(lines._sketches(table.select("line"))), stash, 0.8)
        held = {r["h"]: r["line"] for r in table.collect()}
        label = {h: h for h in held}
        found = {frozenset((r["a"]["h"], r["b"]["h"])) for r in met.collect()}
        surely = [(r["src"], r["dst"]) for r in sure.collect()]
        for a, b in surely:
            label[a] = b
        sets = {h: {x[k : k + 8] for k in range(max(1, len(x) - 7))} for h, x in held.items()}
        alike = lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
        assert all(alike(a, b) for a, b in surely)
        near = {frozenset((a, b)) for a in held for b in held if a < b and alike(a, b)}
        assert near
        assert all(len({label[h] for h in pair}) == 1 or pair in found for pair in near)
