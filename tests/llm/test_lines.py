import random

import pytest

from tablesmith.llm import lines

WORDS = [a + b + c for a in "bcdfgh" for b in "aeiou" for c in ("n", "rst", "llow", "m", "ts")]


def shingles(line):
    return {line[k : k + 8] for k in range(max(1, len(line) - 7))}


def alike(x, y):
    both = len(x & y)
    return 5 * both >= 4 * (len(x) + len(y) - both)


def brute(docs):
    at = sorted({(d, n, x) for d, text in docs for n, x in enumerate((text or "").split("\n")) if x.strip("\t\n\x0b\x0c\r ")})
    label = list(range(len(at)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    sets = [shingles(x) for _, _, x in at]
    for i in range(len(at)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return {(d, n): at[top(i)][:2] for i, (d, n, _) in enumerate(at)}


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(2)
    base = [" ".join(rng.choice(WORDS) for _ in range(n)) for n in [1, 2, 4, 10, 14, 20, 25, 30, 50, 60, 90]]
    out = []
    for d in range(60):
        text = []
        for _ in range(rng.randint(0, 6)):
            words = rng.choice(base).split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            text.append(" ".join(words) if rng.random() < 0.7 else " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 40))))
        out.append((d, "\n".join(text)))
    return out + [(100, None), (101, ""), (102, "\n \n"), (103, "é\nab\nab\nf ff\n\x0b\x0c\r"), (104, "x" * 5000), (105, "x" * 5000 + "y")]


def test_classes_match_brute_force(spark, docs):
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, h int")
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in lines.line_classes(frame).collect()}
    assert got == brute(docs)


def test_dedup_rewrites_texts(spark):
    rows = [(1, "one two three four\nfive six seven eight", "k"), (2, "one two three four", "k"), (3, "\nfive six seven eight\nother words here\n", "k"), (4, None, "k"), (5, "", "k"), (5, "", "k")]
    out = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, line string"))
    assert out.columns == ["doc_id", "text", "line"]
    assert sorted((r["doc_id"], r["text"] or "") for r in out.collect()) == [(1, rows[0][1]), (3, "\nother words here\n"), (4, ""), (5, ""), (5, "")]
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
