import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from tablesmith.llm import forest
from tablesmith.llm.common import Stash
from tablesmith.llm.components import components
from tablesmith.llm.sieve import without

WORDS = [a + b for a in "bcdfghklmnprst" for b in ("an", "e", "illo", "os", "um")]


def shingles(text):
    w = (text or "").split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def classes(pairs, nodes):
    label = {n: n for n in nodes}

    def top(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        label[b] = a
    return {n: top(n) for n in nodes}


def test_prefixes_shorten_until_the_target_recall():
    floor = forest.matched_prefix()
    assert forest.recall(floor) >= forest.RECALL > forest.recall(floor + 1) and floor < forest.DEPTH
    assert forest.matched_prefix(similarity=0.5) < floor and forest.matched_prefix(trees=1, target=1.0) == 1
    assert forest.next_prefix(10, None) == floor == forest.next_prefix(10, 0.8) and forest.next_prefix(floor, 0.8) is None
    for lowest in (0.8, 0.85, 0.9, 0.99):
        prefix, seen = forest.DEPTH, []
        while prefix:
            seen.append(prefix)
            prefix = forest.next_prefix(prefix, lowest)
        assert seen == sorted(set(seen), reverse=True) and seen[-1] == floor
    assert forest.next_prefix(10, 0.9) > floor


def test_labels_share_prefixes_as_often_as_similarity_asks():
    rng = np.random.default_rng(4)
    values, at = [], [0]
    for _ in range(300):  # pairs of sets with similarity 0.8
        both = rng.integers(0, 1 << 63, 80)
        values += [np.sort(np.concatenate([both, rng.integers(0, 1 << 63, 10)])) for _ in range(2)]
        at += [at[-1] + 90, at[-1] + 180]
    found = forest.labels(np.concatenate(values).astype(np.uint64), np.array(at), 24, 10)
    same = (found[::2] ^ found[1::2]) >> np.uint64(6 * 4) == 0
    assert abs(same.mean() - 0.8**6) < 0.03 and same.any(1).mean() >= 0.99


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(6)
    out = []
    for family in range(25):
        base = [rng.choice(WORDS) for _ in range(rng.choice([1, 3, 5, 8, 40, 150]))]
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            out.append(" ".join(words))
    base = [rng.choice(WORDS) for _ in range(120)]
    for _ in range(600):  # one group over several blocks
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(120)] = rng.choice(WORDS)
        out.append(" ".join(words))
    rng.shuffle(out)
    return [(3 * k + 1, t) for k, t in enumerate(out)] + [(9001, None), (9002, ""), (9003, " \n")]


def test_links_and_classes_match_brute_force(spark, docs):
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs] + [(docs[0][0], docs[0][1], 1)], "doc_id long, text string, family int")
    rows = forest.jaccard_join(frame).collect()
    got = {r["doc_id"]: (r["class_id"], r["rep_id"], r["n_links"]) for r in rows}
    assert len(rows) == len(docs) + 1
    reps = {}
    for d, t in sorted(docs):
        reps.setdefault(t or "", d)
    sets = {d: shingles(t) for t, d in reps.items()}
    held = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            held[x].append(d)
    candidates = {p for ds in held.values() for p in combinations(sorted(ds), 2)}
    pairs = [(a, b) for a, b in candidates if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    label, links = classes(pairs, sets), defaultdict(int)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    assert len(pairs) > 5000
    want = {d: (label[reps[t or ""]], reps[t or ""], links[reps[t or ""]]) for d, t in docs}
    assert got == want
    kept = forest.one_of_each_class(frame)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {c for c, _, _ in want.values()}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert forest.jaccard_join(empty).count() == 0 and forest.one_of_each_class(empty).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(300, 301), (301, 302), (302, 300), (5, 5)] + [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(80)]
    want = classes([e for e in edges if e[0] != e[1]], {n for a, b in edges if a != b for n in (a, b)})
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "src long, dst long"), Stash(spark, "test")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "src long, dst long"), Stash(spark, "test")).count() == 0


def test_without_is_an_anti_join(spark):
    df, keys = spark.range(0, 4000).withColumnRenamed("id", "k"), spark.range(0, 4000, 7).withColumnRenamed("id", "k")
    assert {r["k"] for r in without(df, keys, "k").collect()} == {k for k in range(4000) if k % 7}
    assert without(df, keys.filter("k < 0"), "k").count() == 4000
