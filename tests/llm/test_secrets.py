import base64
import gzip
import re
from urllib.parse import quote

from tablesmith.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    return sorted(out + [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16])


def spans(text, kind=None):
    return [(f["kind"], f["start"], f["end"]) for f in secrets.find(text) if kind in (None, f["kind"])]


def test_base_matches_plain_patterns():
    for text in ("", "password=abc", 'x Token: "abcdefghijkl" y', "secret=token:abcdefghijklmnop", "AKIAABCDEFGHIJKLMN AKIAABC", "deadbeefdeadbeef0 zz" * 3, "é PASSWORD = \u212aabcdefghijklmno"):
        assert sorted(secrets.base_spans(text)) == brute(text)


def test_layers_map_to_the_text():
    hidden = "password=Zm9vYmFyMTIzNDU2"
    url = "see " + quote(hidden, safe="") + " end"
    assert ("assign", 4, 4 + len(quote(hidden, safe=""))) in spans(url)
    blob = base64.b64encode(hidden.encode()).decode()
    got = spans(f"é {blob} end", "assign")
    assert got == [("assign", 2, 2 + len(blob.rstrip("=")))]
    nested = base64.b64encode(quote(base64.b64encode(gzip.compress(hidden.encode())).decode(), safe="").encode()).decode()
    got = spans(f"a {nested}", "assign")
    assert len(got) == 1 and got[0][1] >= 2 and got[0][2] <= 2 + len(nested)
    escaped = "".join(f"\\u{ord(c):04x}" for c in hidden)
    assert ("assign", 1, 1 + len(escaped)) in spans("x" + escaped)


def test_cycles_and_junk_end():
    text = "%25" * 50 + "A" * 400 + "%%% \\u12 " + "\\ud83d\\ude00"
    assert spans(text) == []
    assert secrets.find("%2525252570assword=abcdefghijklmn")


def test_scan_handles_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (2, "", 5), (3, "token = 'abcdefghijkl'", None)]
    out = {(r["doc_id"], len(r["findings"])) for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, findings int")).collect()}
    assert out == {(1, 0), (2, 0), (3, 1)}
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_base64_behind_characters_of_its_alphabet():
    hidden = b"password=Zm9vYmFyMTIzNDU2"
    for head in ("/data/", "x", "ab/", "path/to/file/"):
        for raw in (hidden, gzip.compress(hidden), b"\x00\xff\x80" + hidden + b"\xfe"):
            blob = base64.b64encode(raw).decode()
            (got,) = spans(f"see {head}{blob} end", "assign")
            assert 4 <= got[1] and got[2] <= 4 + len(head) + len(blob)
            if raw == hidden:
                assert got[1] == 4 + len(head) and got[2] == 4 + len(head) + len(blob.rstrip("="))


def test_other_text_encodings():
    hidden = "clé: password=Zm9vYmFyMTIzNDU2"
    for kind in ("latin-1", "utf-16", "utf-16-le", "utf-16-be", "utf-8"):
        blob = base64.b64encode(hidden.encode(kind)).decode()
        (got,) = spans(f"see {blob} end", "assign")
        step = 2 if "16" in kind else 1
        first = hidden.index("password") * step + (2 if kind == "utf-16" else 0) + (kind == "utf-8")
        assert got[1] == 4 + first * 4 // 3 and got[2] == 4 + len(blob.rstrip("="))


def test_good_parts_of_a_run_of_percent_escapes():
    text = "%FF%E9" + quote("password=", safe="").replace("p", "%70") + "%C3%A9%FFZm9vYmFyMTIzNDU2"
    assert not spans(text, "assign")  # the value begins behind what can't be decoded
    run = "".join(f"%{ord(c):02X}" for c in "password=Zm9vYmFyMTIz")
    assert ("assign", 7, 7 + len(run)) in spans("a%FF%80" + run)


def test_blob_layers_have_one_span():
    layer = secrets.Layer("a%41%FF\\u0041", "text", span=(3, 90))
    made = [secrets._percent(layer), secrets._escapes(layer)]
    assert [x.text for x in made] == ["aA%FF\\u0041", "a%41%FFA"] and all(x.span == (3, 90) and x.starts is None for x in made)
