import random
import re
from collections import Counter

import numpy as np

from tablesmith.llm import quality

VOWELS, CONSONANTS = "aeiou", "bcdfglmnprst"


def word(rng):
    return rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.4 else "".join(rng.choice(CONSONANTS) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4)))


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words)


def test_distance():
    p, q = np.array([[1.0, 0, 0], [1, 1, 2], [0, 0, 0]]), np.array([0.0, 1, 0])
    assert np.allclose(quality.distance(p[:1], q), 1) and np.allclose(quality.distance(p[1:2], p[1:2]), 0) and quality.distance(p[2:], q)[0] == 0


def test_counts_and_verdicts(spark):
    rng = random.Random(5)
    docs = [(k, " ".join(word(rng) for _ in range(rng.randint(60, 300))).capitalize() + ".", "en") for k in range(200)]
    shout = [(1000, docs[0][1].upper().replace(" ", "!! "), "en"), (1001, re.sub(r" ", "### ", docs[1][1]), "en"), (1002, " ".join(f"{chr(97 + k % 26)}q{k}" for k in range(200)), "en")]
    odd = [(2000, None, "en"), (2001, "", None), (2002, "a b c " * 40, "en"), (2003, "\n x\n x\n\n", "zz"), (2004, "é ü\x85 日本 " * 30, "xx-9"), (2004, "é ü\x85 日本 " * 30, "xx-9"), (2005, docs[3][1].upper(), "unknown tag")]
    frame = spark.createDataFrame([(*r, 1) for r in docs + shout + odd], "doc_id long, text string, lang string, n_words int")
    got = {r["doc_id"]: r for r in quality.quality(frame).collect()}
    for d, text, _ in docs + shout + odd:
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(text), d
    assert all(got[d]["kept"] != got[d]["base_failed"] for d, _, _ in docs) and not any(got[d]["kept"] for d, _, _ in shout)
    assert got[2005]["kept"] and got[2005]["chars_apart"] == 0 and not got[2000]["kept"]
    good = quality.keep_good(frame)
    assert good.columns == frame.columns and {r["doc_id"] for r in good.collect()} == {d for d, r in got.items() if r["kept"]}
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert quality.quality(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_references_match_plain_counting(spark):
    rng = random.Random(6)
    docs = [(k, " ".join(word(rng) for _ in range(200)), lang) for k in range(30) for lang in ("en", "de")]
    refs = quality.references(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    for lang in ("en", "de"):
        words = Counter(w for _, t, l in docs if l == lang for w in t.split())
        classes, keys, counts = refs[lang]
        assert sorted(counts[:-1].tolist(), reverse=True) == [n for _, n in words.most_common(quality.COMMON_WORDS)] and counts.sum() == sum(words.values())
        assert classes[0] == sum(len(w) * n for w, n in words.items()) and len(keys) == quality.COMMON_WORDS


def test_tags_are_read_as_their_language(spark):
    assert [quality.language(t) for t in ("en", "EN", "pt-BR", "zh_Hant", "deu", None, "", "english", "e")] == ["en", "en", "pt", "zh", "deu", "", "", "", ""]
    rng = random.Random(4)
    docs = [(k, " ".join(word(rng) for _ in range(200)), tag) for k in range(20) for tag in ("en", "EN", "en-GB", "no tag at all")]
    refs = quality.references(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert list(refs) == ["en"] and refs["en"][2].sum() == 3 * 20 * 200
