import random

from pyspark.sql import functions as F

from tablesmith.llm import lines
from tests.llm.test_lines import WORDS, alike, shingles


def test_sketches_rule_out_only_lines_that_are_not_similar(spark):
    rng = random.Random(5)
    texts = ["😀 straße " * 30, "x" * 500, "short"]
    for n in (10, 40, 90):
        words = [rng.choice(WORDS) for _ in range(n)]
        for changes in range(0, n // 2, max(1, n // 12)):
            texts.append(" ".join(rng.choice(WORDS) if k < changes else w for k, w in enumerate(words)))
    texts = sorted(set(texts) | {t + " 😀" for t in texts})
    table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, line string").withColumn("h", F.xxhash64("line"))
    sketched = lines._sketches(table).join(table, "h").select("k", F.struct("n", *lines.SKETCH).alias("s"))
    both = sketched.toDF("i", "x").crossJoin(sketched.toDF("j", "y")).filter("i < j")
    perhaps = {(r["i"], r["j"]) for r in both.filter(lines._perhaps("x", "y", 0.8)).select("i", "j").collect()}
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for j in range(len(texts)) for i in range(j)]
    near = {(i, j) for i, j in pairs if alike(sets[i], sets[j])}
    assert near and near <= perhaps
    assert len(perhaps) < len(near) + (len(pairs) - len(near)) / 4
