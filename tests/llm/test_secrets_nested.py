"""Random nestings of encodings: what is hidden in them is found, with a span in the blob."""

import base64
import bz2
import gzip
import lzma
import random
import zlib
from urllib.parse import quote

import pytest

from tablesmith.llm import secrets

HIDDEN = "password=Zm9vYmFyMTIzNDU2"


def deflate(raw):
    c = zlib.compressobj(9, zlib.DEFLATED, -15)
    return c.compress(raw) + c.flush()


def mail(raw):
    return base64.encodebytes(raw).decode().rstrip("\n")


def pem(raw):
    text = base64.b64encode(raw).decode()
    return "\r\n".join("  " * (k > 0) + text[k : k + 64] for k in range(0, len(text), 64))


#: From text to text, and from bytes to text; and from bytes to bytes.
TEXT = {
    "url": lambda t: quote(t, safe=""),
    "every url": lambda t: "".join(f"%{b:02X}" for b in t.encode()),
    "unicode": lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
    "braces": lambda t: "".join(f"\\u{{{ord(c):x}}}" for c in t),
}
BYTES = {
    "base64": lambda b: base64.b64encode(b).decode(),
    "url-safe": lambda b: base64.urlsafe_b64encode(b).decode().rstrip("="),
    "mail": mail,
    "pem": pem,
}
WRITTEN = {
    "percent": lambda b: quote(b, safe=""),
    "repr": lambda b: repr(b)[2:-1],
    "hex escapes": lambda b: "".join(f"\\x{x:02x}" for x in b),
    "json": lambda b: "".join(f"\\u00{x:02x}" for x in b),
}
PACKED = {"gzip": gzip.compress, "zlib": zlib.compress, "fast zlib": lambda b: zlib.compress(b, 1), "bz2": bz2.compress, "xz": lzma.compress}


def nested(rng, depth):
    text, names = f"x {HIDDEN} y", []
    for _ in range(depth):
        way = rng.randrange(4)
        if way == 0:
            name = rng.choice(sorted(TEXT))
            text = TEXT[name](text)
        elif way == 1:
            name = rng.choice(sorted(BYTES))
            text = BYTES[name](text.encode())
        elif way == 2:
            packed, name = rng.choice([*sorted(PACKED), "deflate"]), rng.choice(sorted(BYTES))
            text = BYTES[name]((deflate if packed == "deflate" else PACKED[packed])(text.encode()))
            name = f"{packed} in {name}"
        else:
            packed, name = rng.choice(sorted(PACKED)), rng.choice(sorted(WRITTEN))
            text = WRITTEN[name](PACKED[packed](text.encode()))
            name = f"{packed} in {name}"
        names.append(name)
    return text, names


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_random_nestings(depth):
    rng = random.Random(depth)
    for _ in range(150 if depth < 4 else 60):
        blob, names = nested(rng, depth)
        text = f"before that: {blob} and on it goes"
        found = [f for f in secrets.find(text) if f["value"] == HIDDEN]
        assert found, (names, text[:300])
        assert any(13 <= f["start"] < f["end"] <= 13 + len(blob) for f in found), (names, [(f["start"], f["end"]) for f in found], len(blob))


def test_spans_of_written_out_streams():
    blob = "".join(f"%{x:02x}" for x in gzip.compress(HIDDEN.encode()))
    (found,) = [f for f in secrets.find(f"a {blob}%20 b x^y x^z") if not f["base"]]
    assert (found["start"], found["end"], found["kind"]) == (2, 2 + len(blob), "assign")
    two = "".join(f"\\x{x:02x}" for x in zlib.compress(b"nothing here")) + " x " + repr(zlib.compress(HIDDEN.encode()))
    (found,) = [f for f in secrets.find(two) if not f["base"]]
    assert two.index("b'") + 2 == found["start"] and found["end"] == len(two) - 1


def test_lines_of_prose_and_hashes_give_no_more():
    text = "deadbeefdeadbeef00\nfeedfacefeedface11\nabcdefghijklmnopqrst\nand then\nx^2 + x^3 BZh9 are no streams"
    assert [(f["kind"], f["base"]) for f in secrets.find(text)] == [("hex", True), ("hex", True)]
    long = "x^" * 20000 + "\\x78\\x9c" * 5000 + ("A" * 76 + "\n") * 2000
    assert secrets.find(long) == []
