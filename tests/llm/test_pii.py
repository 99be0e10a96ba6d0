import random
import re

from tablesmith.llm import pii


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        s = sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(d[::-1]))
        if 12 <= len(d) <= 19 and s % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out)


def test_base_matches_plain_patterns():
    rng = random.Random(5)
    parts = ["a.b@c.d", "@", "x@y", "@y.com", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "4111 1111 1111 1111", "4111111111111111", "+1 (255) 555-8013", "+49-30 12", " ", ".", "-", "7", "0001.2.3.4", "é", "a@b.c@d.e", "+", "zz"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert sorted(pii.base_spans(text)) == brute(text), text


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"dial now +1 (255) 555-80{i:02d} please today", 1) for i in range(40)]
    rows += [(100, "dial now 555-123-4567 please today", 1), (101, "the sum 555-123-4568 was right", 1), (102, None, 1), (103, "", 1)]
    out = {r["doc_id"]: r["findings"] for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string, kind int")).collect()}
    assert [(f["kind"], f["start"], f["end"], f["base"]) for f in out[100]] == [("phone", 9, 21, False)]
    assert not out[101] and not out[102] and not out[103]
    assert all([(f["kind"], f["base"]) for f in out[i]] == [("phone", True)] for i in range(40))
    assert pii.extract(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_found_identifiers_induce_patterns(spark):
    """Seeds give "dial now", whose finds stand after "reach desk" too, whose finds no seed's words surround."""
    rows = [(1000 + i, f"dial now +1 (255) 555-8{i:03d} please") for i in range(300)]
    rows += [(100 + i, f"dial now 555-123-40{i:02d} please") for i in range(60)]
    rows += [(200 + i, f"reach desk 555-123-40{i:02d} anytime") for i in range(60)]
    rows += [(300, "reach desk 555-777-1234 anytime"), (301, "weighs about 555-777-9999 grams"), (302, None)]
    rows += [(400 + i, f"the sum 555-999-{1000 + i} was right") for i in range(9)]
    out = {r["doc_id"]: [f["kind"] for f in r["findings"]] for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[100 + i] == out[200 + i] == ["phone"] for i in range(60))
    assert out[300] == ["phone"] and not out[301] and not out[302] and not any(out[400 + i] for i in range(9))


def test_rows_keep_their_own_finds(spark):
    """Rows of one doc_id, or of none, get what their own text holds."""
    rows = [(i, f"dial now +1 (255) 555-80{i:02d} please") for i in range(40)]
    rows += [(None, "dial now 555-123-4567 please"), (None, "no data"), (7, "dial now 555-123-4568 please"), (7, "none")]
    got = sorted((str(r["doc_id"]), [f["start"] for f in r["findings"]]) for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["doc_id"] in (None, 7))
    assert got == sorted([("7", [9]), ("7", [9]), ("7", []), ("None", [9]), ("None", [])])


def test_patterns_are_words_of_any_distance():
    text = "one" + " " * 500 + "two  9.9.9.9\n\n" + "\n" * 300 + "three (four) " + "x" * 70
    at = text.index("9.9")
    assert pii.Words(text).patterns(at, at + 7) == ["L two", "LL one two", "LR two _ three", "RR three four"]
    assert pii.Words("x" * 65 + " 9.9.9.9").patterns(66, 73) == [] and pii.Words("ip:9.9.9.9, ok").patterns(3, 10) == ["L ip"]
