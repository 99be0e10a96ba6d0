import random
import re

import numpy as np
import pyarrow as pa

from tablesmith.llm import words


def sets(texts):
    values, at = words.shingles(pa.array(texts))
    return [set(values[at[i] : at[i + 1]].tolist()) for i in range(len(texts))]


def test_shingles_are_equal_where_words_are():
    rng = random.Random(3)
    parts = ["a", "bb", "é", "日本", " ", "\n", "\t ", "\x85", " ", "c.d", "aa"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 30))) for _ in range(300)] + ["", None, " ", "x" * 3000]
    plain = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        plain.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    got = sets(texts)
    assert [len(x) for x in got] == [len(x) for x in plain]
    by_value = {}
    for g, t in zip(got, texts):
        for v in g:
            by_value.setdefault(v, []).append(t)
    for i in range(0, 300, 7):
        for j in range(1, 300, 11):
            assert len(got[i] & got[j]) == len(plain[i] & plain[j])


def test_chunks_cover_all_texts():
    at = np.cumsum([0, 5, 0, 900, 3, 3, 3, 2000, 1])
    parts = list(words.chunks(at, 10))
    assert [i for i, _ in parts] == [0, *[j for _, j in parts][:-1]] and parts[-1][1] == 8
