import random
import re

import pytest

from tablesmith.llm import licenses

WORDS = [a + b + c for a in "bcdfg" for b in "aeiou" for c in ("n", "rst", "llow", "m", "ts")]


def grams(text):
    words = re.findall(r"[^\W_]+", text.lower())
    return words, {tuple(words[k : k + 3]) for k in range(len(words) - 2)}


def test_notices_are_found(spark):
    rng = random.Random(8)
    docs = []
    for d in range(150):
        words = [rng.choice(WORDS) for _ in range(rng.randint(0, 200))]
        if d % 3 == 0:
            notice = licenses.NOTICES[d // 3 % len(licenses.NOTICES)][1]
            words[(at := rng.randint(0, len(words))) : at] = [notice.upper() if d % 2 else notice]
        docs.append((d, " ".join(words), "x"))
    docs += [(500, None, "x"), (501, "", "x"), (502, "All rights", "x"), (503, "all rights reserved", "x"), (503, "all rights reserved", "x")]
    docs += [(504, "word " * 5000 + "Released under the MIT license" + " word" * 5000, "x"), (505, "Licensed under the Apache Software License, Version 2.0", "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, license string")
    got = {(r["doc_id"], r["license"]): (r["start_word"], r["end_word"], r["containment"]) for r in licenses.scan(frame).collect()}
    want: dict[tuple[int, str], float] = {}
    passages = set()
    for d, text, _ in docs:
        words, _ = grams(text or "")
        for name, notice in licenses.NOTICES:
            own, need = grams(notice)
            n = len(own)
            held = lambda s, size: len({tuple(words[k : k + 3]) for k in range(s, min(len(words), s + size) - 2)} & need) / len(need)
            # Windows of twice the template's length at every length, as the operator looks at them.
            best = max((held(s, 2 * n) for s in range(0, max(1, len(words)), n)), default=0)
            if best >= 0.8:
                want[d, name] = max(best, want.get((d, name), 0))
            if any(held(s, n) >= 0.8 for s in range(max(1, len(words) - n + 1))):
                passages.add((d, name))
    assert {k: v[2] for k, v in got.items()} == pytest.approx(want) and passages <= set(want) and len(want) >= 50
    assert got[503, "Proprietary"] == (0, 3, 1.0) and got[504, "MIT"][:2] == (5000, 5005)
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bands_grow_for_short_templates():
    assert licenses.bands(3) > licenses.bands(30) and 1 - (1 - 0.2) ** licenses.bands(3) >= 0.99
