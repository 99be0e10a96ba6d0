import math
import random

from tablesmith.llm import toxicity


def test_folding():
    assert toxicity.fold("ІDІ0T! Idíot id1ot, 1d!ot") == ["idiot"] * 4
    assert toxicity.fold("a-b  c") == ["a", "b", "c"] and toxicity.fold("") == []


def test_hits_and_exceptions():
    lexicon = toxicity.Lexicon({"\nidiot\n": 3.0, "\nscum": 2.0}, frozenset({"pond scum"}), (-3.0, 1.0, 1.0))
    assert lexicon.hits(toxicity.fold("you 1diot scumbag")) == {1: 3.0, 2: 2.0}
    assert lexicon.hits(toxicity.fold("pond scum idiots")) == {}
    assert lexicon.score("you idiot") > lexicon.score("you idiot " + "word " * 400) > lexicon.score("fine words") == lexicon.score("")


def test_learns_labels_and_scores_held_out(spark):
    rng = random.Random(4)
    plain, bad = [f"w{chr(97 + i)}{chr(97 + j)}xy" for i in range(20) for j in range(10)], ["grumbold", "snarkle", "voidwit"]
    docs, labels = [], []
    for i in range(1200):
        toxic = i % 5 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if toxic:
            words[2:2] = [rng.choice(bad), rng.choice(bad).replace("o", "0").upper()]
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    docs += [(5000, None, "x"), (5001, "", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, label string")
    lexicon = toxicity.learn(frame, spark.createDataFrame([r for r in labels if r[0] % 4], "doc_id long, toxic int"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(frame, lexicon).collect()}
    assert all((scores[i] >= toxicity.TOXIC) == bool(t) for i, t in labels)
    assert len(scores) == len(docs) and scores[5000] == scores[5001] < 0.1


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    lexicon = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["score"] < 0.3 for r in toxicity.score(docs, lexicon).collect()] == [True, True]


def brute_score(text, weights, exceptions, line):
    """The score by its definition: every entry against every word."""
    words = toxicity.fold(text)
    total = 0.0
    for k, w in enumerate(words):
        own = [v for e, v in weights.items() if (e == f"\n{w}\n" if e.endswith("\n") else w.startswith(e[1:]))]
        near = ({f"{words[k - 1]} {w}"} if k else set()) | ({f"{w} {words[k + 1]}"} if k + 1 < len(words) else set())
        total += max(own, default=0.0) * (not near & exceptions)
    z = line[0] + line[1] * math.log1p(total) + line[2] * math.log1p(100 * total / (len(words) + toxicity.SHORT))
    return 1 / (1 + math.exp(-z))


def test_scores_equal_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abo1@Оé") for _ in range(rng.randint(1, 7)))
    pool = [word() for _ in range(60)]
    folded = [w for p in pool for w in toxicity.fold(p)]
    weights = {f"\n{w}\n": rng.uniform(1, 4) for w in rng.sample(sorted(set(folded)), 12)} | {f"\n{w[:4]}": rng.uniform(1, 4) for w in folded if len(w) > 4 and rng.random() < 0.3}
    exceptions = frozenset(f"{rng.choice(folded)} {rng.choice(folded)}" for _ in range(400))
    line = (-2.0, 0.7, 0.4)
    docs = [(k, " ".join(rng.choice(pool) + rng.choice(["", "", "!", ",", "-x"]) for _ in range(rng.choice([0, 1, 2, 30, 300])))) for k in range(150)] + [(200, None)]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"), toxicity.Lexicon(weights, exceptions, line)).collect()}
    assert all(abs(got[d] - brute_score(t or "", weights, exceptions, line)) < 1e-12 for d, t in docs) and len(set(got.values())) > 60


def test_weights_are_log_odds_of_documents(spark):
    docs = [(k, f"{'vile ' * (k % 3 == 0)}{'mild ' * (k % 2)}word") for k in range(400)]
    labels = [(k, int(k % 3 == 0 and k % 5 < 4)) for k in range(400)]
    lexicon = toxicity.learn(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    lesson = [r["doc_id"] for r in spark.range(400).toDF("doc_id").filter("pmod(xxhash64(doc_id, 'toxicity'), 4) <> 0").collect()]
    toxic = {k for k, t in labels if t} & set(lesson)
    clean = set(lesson) - toxic
    odds = math.log((len(toxic) + 0.5) / (len(toxic) + 1)) - math.log((sum(k % 3 == 0 for k in clean) + 0.5) / (len(clean) + 1))
    assert set(lexicon.weights) == {"\nvile\n"} and abs(lexicon.weights["\nvile\n"] - odds) < 1e-9
