import base64
import bz2
import gzip
import lzma
import zlib

from tablesmith.llm import secrets

HIDDEN = b"password=Zm9vYmFyMTIzNDU2 "


def kinds(raw):
    return {f["kind"] for f in secrets.find("a " + base64.b64encode(raw).decode() + " z")}


def test_layers_of_any_length_are_scanned():
    filler = b"plain words \xc3\xa9\n" * 5_000_000
    assert len(filler) > 1 << 26
    assert kinds(gzip.compress(filler + HIDDEN, 1)) == {"assign"}
    assert kinds(gzip.compress(filler, 1)) == set()


def test_all_members_are_scanned():
    for pack in (gzip.compress, bz2.compress, lzma.compress, zlib.compress):
        assert kinds(pack(b"nothing here ") + pack(HIDDEN)) == {"assign"}
        assert kinds(pack(HIDDEN[:12]) + pack(HIDDEN[12:])) == {"assign"}
        assert kinds(pack(HIDDEN) + pack(b"\xff\xfe\x00" * 50)) == {"assign"}
        assert kinds(pack(HIDDEN) + b"junk") == {"assign"}
        assert kinds(pack(pack(b"none ") + pack(HIDDEN))) == {"assign"}
        assert kinds(pack(b"plain words here ") + pack(pack(HIDDEN))) == {"assign"}
        broken = pack(HIDDEN)[:-9]  # xz stores short texts as they are, which are then read as what is readable in the blob
        assert kinds(broken) == ({"assign"} if HIDDEN.strip() in broken else set())
