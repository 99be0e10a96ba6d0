"""Spelling variants against plain Python."""

import random
import zlib
from collections import Counter

from tablesmith.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced code point leads from a to b, by definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def letters(c):
    return "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ"


def brute(docs):
    counts = Counter()
    for doc_id, text in docs:
        run = ""
        for c in (text or "") + " ":
            if letters(c):
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += len(run) >= 7
            run = ""
    words = {w: n for w, n in counts.items() if n >= 2}
    out = {}
    for w, n in words.items():
        others = sorted((-words[v], v) for v in words if near(w, v))
        form = others[0][1] if others and -others[0][0] >= 10 * n else None
        out[w] = [n, form, None, len(others), words[form] if form else None]
    for w, row in out.items():
        row[2] = w
        while out[row[2]][1]:
            row[2] = out[row[2]][1]
    return {(w, *row) for w, row in out.items()}


def documents(rng):
    stems = ["consider", "consonant", "ÉTRANGER", "étranger", "straßenbau", "banananana", "abcdefgh"]
    words = []
    for s in stems:
        words += [s] * rng.choice([200, 1500])
        for _ in range(40):
            k, c = rng.randrange(len(s)), rng.choice("abcdeéßx×")
            v = rng.choice([s[:k] + s[k + 1 :], s[:k] + c + s[k:], s[:k] + c + s[k + 1 :], s[:k] + s[k + 1 : k + 2] + s[k : k + 1] + s[k + 2 :]])
            words += [v] * rng.choice([1, 2, 3, 30])
            words += [v[:3] + rng.choice("xyz") + v[3:]] * rng.choice([1, 2, 3])
    rng.shuffle(words)
    out = [(k, " ".join(words[k::300])) for k in range(300)]
    return [*out, (None, "consider, considers considers"), (5, None), (6, ""), (7, "short words only"), (8, "z" * 5000 + " " + "z" * 5000 + "\n" + "z" * 4999 + "-" + "z" * 4999), (9, "Consideŕed consideŕed"), (1, out[1][1]), (1, out[1][1])]


def test_variants_equal_brute_force(spark):
    docs = documents(random.Random(13))
    frame = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in docs], "doc_id long, text string, word string, n int, value string")
    got = spelling.variants(frame).collect()
    assert {tuple(r[c] for c in ("word", "n", "form", "root", "n_near", "form_n")) for r in got} == brute(docs)
    assert len({r["word"] for r in got}) == len(got)
    assert any(r["root"] not in (r["form"], r["word"]) for r in got)  # a chain of two
    assert spelling.variants(frame.limit(0)).count() == 0


def test_all_near_words_meet():
    rng = random.Random(14)
    for _ in range(3000):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(7, 12)))
        k, c = rng.randrange(len(a)), rng.choice("abéz")
        b = rng.choice([a[:k] + a[k + 1 :], a[:k] + c + a[k:], a[:k] + c + a[k + 1 :]])
        if a == b:
            continue
        met = {(v, h): w for v, h, w in spelling.meetings(a)}
        assert any((v, h) in met and not (w and met[v, h]) for v, h, w in spelling.meetings(b)), (a, b)


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    docs = [(k, f"wordnumber{chr(97 + k % 26)} wordnumberz") for k in range(2000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    whole = {tuple(r) for r in spelling.word_counts(frame).collect()}
    monkeypatch.setattr(spelling, "HELD", 10)
    assert {tuple(r) for r in spelling.word_counts(frame).collect()} == whole and len(whole) >= 26
