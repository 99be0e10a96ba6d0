"""Fill-in-middle against plain Python: the automaton's counts, the cuts, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.llm import fill_middle as fim

ODD = ["", "a", "é", "<P>", "<P", "x<S>y", "<<M>>", "<P<S", "日本語テキスト", "a b\n\nc  d\te ", "\n", " ", "𝒳𝒴 <Z> é\r\nq", "<" * 700 + "P>", "word " * 5000, "é" * 1023 + "<S" + ">" * 3]


def units(text, unit):
    if unit == "char":
        return list(text)
    if unit == "line":
        return re.findall(r"[^\n]*\n|[^\n]+", text)
    return re.findall(r"[ \t\n\v\f\r]+|[^ \t\n\v\f\r]+[ \t\n\v\f\r]*", text)


def brute(doc_id, text, unit="char"):
    """(n, form, prefix_chars, middle_chars, output) by the definition."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    parts = units(text, unit)
    n = len(parts)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def random_text(rng):
    return "".join(rng.choice(["<", "P", "S", "M", ">", " ", "\n", "a", "é", "日", "𝒳", "<P>"[: rng.randrange(3)]]) for _ in range(rng.choice([1, 5, 40, 255, 256, 257, 900])))


def test_counts():
    rng = random.Random(3)
    texts = [t for t in ODD if t] + [random_text(rng) for _ in range(200)]
    data = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, data)])
    counts = fim.scan(np.frombuffer(b"".join(data), np.uint8), starts[:-1])
    for text, a, b in zip(texts, starts, starts[1:], strict=False):
        seen = counts[a:b]
        for unit in ("char", "word", "line"):
            parts = units(text, unit)
            begins = np.flatnonzero(seen & fim.COUNTS[unit])
            assert begins.tolist() == np.cumsum([0, *(len(p.encode()) for p in parts)])[:-1].tolist(), (unit, text[:50])
            for k in {0, len(parts) // 2, len(parts)}:
                assert fim.place(seen, fim.COUNTS[unit], k, block=64) == len("".join(parts[:k]).encode())
        ends = [len(text[: m.end()].encode()) - 1 for m in re.finditer("<[PSM]>", text)]
        assert np.flatnonzero(seen & fim.COUNTS["sentinel"]).tolist() == ends


def test_entry_states_without_convergence(monkeypatch):
    """Where states do not meet within a stretch, they are composed one stretch after another."""
    monkeypatch.setattr(fim, "NEXT", np.array([(s + c) % fim.STATES for s in range(fim.STATES) for c in range(fim.CLASSES)], np.uint8))
    steps = np.random.default_rng(5).integers(0, fim.CLASSES, (fim.STRETCH, 40)).astype(np.uint8)
    want = (fim.START + np.cumsum([0, *steps.astype(int).sum(axis=0)])[:-1]) % fim.STATES
    assert fim._entry_states(steps).tolist() == want.tolist()


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_transform_equals_brute_force(spark, unit):
    rng = random.Random(4)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id here"), (7, None), (1, "a"), (1, "a")] + [(k, random_text(rng)) for k in range(100, 400)]
    docs = spark.createDataFrame([(d, t, "en", 5, None) for d, t in rows], "doc_id long, text string, form string, h1 int, `a b` string")
    made = fim.transform(docs, unit)
    assert made.columns == ["doc_id", "text", "h1", "a b", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple(map(repr, r))
    assert sorted(((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got), key=key) == sorted(((d, t, *brute(d, t, unit)) for d, t in rows), key=key)
    assert all(r["again"] == (r["text"] or "") and r["h1"] == 5 for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(docs.limit(0), unit).count() == 0
