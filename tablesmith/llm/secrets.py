"""Secret scans with a worklist that unwraps nested encodings and maps what it finds back to the text."""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from codecs import getincrementaldecoder
from collections import deque
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain, tee

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import map_rows, text_of
from tablesmith.llm.findings import FINDING, ordered

KINDS = ("assign", "access", "hex")
#: Bytes of a compressed layer that are held and scanned at once; of a longer one parts of this length follow each other,
#: each with the last OVERLAP bytes of the one before.
LAYER_BYTES, OVERLAP = 1 << 26, 1 << 24
#: Bytes that a stream unwraps to at a time.
PIECE = 1 << 20

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\})+")
_ESCAPED = re.compile(r"\\(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2})|U([0-9A-Fa-f]{8}))")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 that is broken into lines: a run up to a line's end, and what the next lines begin with.
_BROKEN_LINES = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)+={0,2}")
_LINE_END = re.compile(r"\r?\n[\x20\t]*")
_URL_SAFE = str.maketrans("-_", "+/")
#: Bytes as a text may write them out: as %XX, as escapes of a language, or as characters of those numbers.
_AS_PERCENT = re.compile(r"%([0-9A-Fa-f]{2})|([\x00-\x24\x26-\xff])")
_AS_ESCAPES = re.compile(r"\\(?:x|u00)([0-9A-Fa-f]{2})|([\x00-\x5b\x5d-\xff])|\\u\{0*([0-9A-Fa-f]{1,2})\}|\\([abfnrtv0'\"\\])")
_AS_CHARACTERS = re.compile(r"()([\x00-\xff])")
_NAMED = dict(zip("abfnrtv0'\"\\", "\x07\x08\x0c\n\r\t\x0b\x00'\"\\", strict=True))
#: Characters of a text that are taken for bytes at first, and at most, at a time: what only looks like a stream breaks soon.
_AT_FIRST, _AT_MOST = 24, 4096


def _written(*codes: int) -> str:
    """A pattern of bytes in any way of writing them."""
    return "".join(rf"(?:%{c:02x}|\\x{c:02x}|\\u00{c:02x}|\\u\{{0*{c:x}\}}|{re.escape(chr(c))}{'|' + chr(92) * 2 + {0: '0', 8: 'b'}[c] if c in (0, 8) else ''})" for c in codes)


#: Where a compressed stream may begin in a text that writes out its bytes.
_STREAM = re.compile("|".join([_written(0x1F, 0x8B, 8), *(_written(0x78, c) for c in (0x01, 0x5E, 0x9C, 0xDA)), _written(*b"BZh") + r"[1-9]" + _written(*b"1AY&SY"), _written(*b"\xfd7zXZ\0")]), re.I)

#: What a text has at least if it writes out such a stream.
_HINTS = ("%", "\\", "\x1f\x8b", "x\x01", "x^", "x\x9c", "x\xda", "BZh", "7zXZ")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the three base patterns: (kind, start, end), leftmost and non-overlapping for each kind."""
    found = []
    low = text.lower()
    if any(word in low for word in _ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


class Layer:
    """A text unwrapped from the document, with the document's span behind each of its characters, or one behind them all."""

    def __init__(self, text: str, via: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None, span: tuple[int, int] | None = None):
        self.text, self.via, self.starts, self.ends, self.span = text, via, starts, ends, span

    @property
    def is_document(self) -> bool:
        return self.starts is None and self.span is None

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The document's span behind characters start to end (end exclusive, at least one)."""
        if self.span is not None:
            return self.span
        return (start, end) if self.starts is None else (int(self.starts[start]), int(self.ends[end - 1]))

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None:
            at = np.arange(len(self.text), dtype=np.int64)
            return at, at + 1
        return self.starts, self.ends

    def derived(self, text: str, via: str, first: np.ndarray, last: np.ndarray) -> Layer:
        """A layer whose characters come from characters first to last (inclusive) of this one."""
        via = f"{self.via}>{via}"
        if self.span is not None:
            return Layer(text, via, span=self.span)
        starts, ends = self.bounds()
        return Layer(text, via, starts[first], ends[last])


def _rewritten(layer: Layer, pieces: list[tuple[int, int, list[tuple[str, int, int]]]], via: str) -> Layer:
    """The layer with each (start, end) replaced by characters that have spans of their own in the layer."""
    text, first, last, at = [], [], [], 0
    for start, end, decoded in pieces:
        text.append(layer.text[at:start])
        text += [c for c, _, _ in decoded]
        if layer.span is None:
            kept = np.arange(at, start)
            first += [kept, np.array([i for _, i, _ in decoded], np.int64)]
            last += [kept, np.array([j - 1 for _, _, j in decoded], np.int64)]
        at = end
    text.append(layer.text[at:])
    if layer.span is not None:
        return Layer("".join(text), f"{layer.via}>{via}", span=layer.span)
    kept = np.arange(at, len(layer.text))
    return layer.derived("".join(text), via, np.concatenate([*first, kept]), np.concatenate([*last, kept]))


def _percent(layer: Layer) -> Layer | None:
    """Runs of %XX as UTF-8; bytes that are none stay as they stand."""
    pieces = []
    for m in _PERCENT.finditer(layer.text) if "%" in layer.text else ():
        at, decoded, some = m.start(), [], False
        for c in bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape"):
            if "\udc80" <= c <= "\udcff":
                decoded += [(layer.text[at + k], at + k, at + k + 1) for k in range(3)]
                at += 3
            else:
                width = 3 * len(c.encode())
                decoded.append((c, at, at + width))
                at, some = at + width, True
        if some:
            pieces.append((*m.span(), decoded))
    return _rewritten(layer, pieces, "url") if pieces else None


def _escapes(layer: Layer) -> Layer | None:
    pieces = []
    for m in _ESCAPE.finditer(layer.text) if "\\" in layer.text else ():
        units = [(int(next(g for g in e.groups() if g), 16), m.start() + e.start(), m.start() + e.end()) for e in _ESCAPED.finditer(m[0])]
        decoded, i = [], 0
        while i < len(units):
            code, start, end = units[i]
            if 0xD800 <= code < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1][0] < 0xE000:
                code, end, i = 0x10000 + ((code - 0xD800) << 10) + units[i + 1][0] - 0xDC00, units[i + 1][2], i + 1
            if code < 0x110000 and not 0xD800 <= code < 0xE000:
                decoded.append((chr(code), start, end))
            else:
                decoded += [(c, start + k, start + k + 1) for k, c in enumerate(layer.text[start:end])]
            i += 1
        pieces.append((*m.span(), decoded))
    return _rewritten(layer, pieces, "unicode") if pieces else None


_PACKED = ((b"\x1f\x8b", "gzip", lambda: zlib.decompressobj(31)), (b"\x78", "zlib", zlib.decompressobj), (b"BZh", "bz2", bz2.BZ2Decompressor), (b"\xfd7zXZ\x00", "xz", lzma.LZMADecompressor))
_BROKEN = (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError)
#: Stands between the pieces of two streams.
_NEXT = None


def _unpacked(pieces: Iterator[bytes], new) -> Iterator[bytes | None]:
    """What a stream and those right behind it unwrap to, in pieces; an error if the first one is broken or cut off."""
    first, data = True, b""
    while new:
        unpack = new()
        try:
            while not unpack.eof:
                if not data and getattr(unpack, "needs_input", True) and not (data := next(pieces, b"")):
                    raise EOFError
                out = unpack.decompress(data, PIECE)
                data = getattr(unpack, "unconsumed_tail", b"")
                if out:
                    yield out
        except _BROKEN:
            if first:
                raise
            return
        first, data = False, unpack.unused_data.lstrip(b"\0")
        while len(data) < 6 and (more := next(pieces, b"")):
            data = (data + more).lstrip(b"\0")
        new = next((n for magic, _, n in _PACKED if data.startswith(magic)), None)
        if new:
            yield _NEXT


def _inflated(pieces: Iterator[bytes | None]) -> tuple[str, Iterator[bytes | None]] | None:
    """The kind of the gzip, zlib, bz2 or xz streams that the pieces are, and what they unwrap to."""
    head = b""
    taken = []
    for piece in pieces:
        taken.append(piece)
        head += piece or b""
        if len(head) >= 6:
            break
    pieces = chain(taken, pieces)
    for magic, name, new in _PACKED:
        if head.startswith(magic):
            pieces, kept = tee(pieces)
            out, held = _unpacked((x for x in pieces if x), new), []
            try:
                size = 0
                while size <= LAYER_BYTES and (piece := next(out, b"")) != b"":
                    held.append(piece)
                    size += len(piece or b"")
            except _BROKEN:
                pieces = kept
                continue
            del kept
            return name, chain(held, out)
    return None


def _parts(pieces: Iterator[bytes | None]) -> Iterator[bytes]:
    """The pieces joined, in parts that overlap if they are long; then each of several streams for itself."""
    part, ends = bytearray(), []
    for piece in pieces:
        if piece is _NEXT:
            ends.append(len(part))
            continue
        part += piece
        if len(part) > LAYER_BYTES:
            yield from _streams(part, ends)
            cut = len(part) - OVERLAP
            part, ends = part[cut:], [x - cut for x in ends if x > cut]
            while part and part[0] & 0xC0 == 0x80:
                part, ends = part[1:], [x - 1 for x in ends]
    yield from _streams(part, ends)


def _streams(part: bytearray, ends: list[int]) -> Iterator[bytes]:
    whole = bytes(part)
    yield whole
    if ends:
        yield from (whole[i:j] for i, j in zip([0, *ends], [*ends, len(whole)]))


def _readable(raw: bytes, cut: bool = False) -> tuple[str, str] | None:
    """raw as text and its encoding: UTF-8, UTF-16 or a Latin one-byte text; cut: the last character may be incomplete."""
    kinds = ["utf-8"]
    if raw[1::2].count(0) * 4 > len(raw) or raw[:2] == b"\xff\xfe":
        kinds.insert(0, "utf-16-le")
    elif raw[::2].count(0) * 4 > len(raw) or raw[:2] == b"\xfe\xff":
        kinds.insert(0, "utf-16-be")
    for kind in [*kinds, "latin-1"]:
        try:
            text = getincrementaldecoder(kind)().decode(raw if kind in ("utf-8", "latin-1") else raw[: len(raw) & ~1], not cut)
        except UnicodeDecodeError:
            continue
        plain = sum(c.isprintable() or c in "\t\n\r\ufeff" for c in text)
        # One byte a character fits any bytes, so that most of them have to be plain.
        if text and plain >= 0.95 * len(text) and (kind != "latin-1" or sum(" " <= c <= "~" for c in text) >= 0.8 * len(text)):
            return text, kind
    return None


#: Runs of printable bytes in what a run of base64 characters decodes to that is no text as a whole.
_PRINTABLE = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){12,}")
#: Where a compressed stream may begin.
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")


def _blobs(layer: Layer) -> list[Iterator[Layer]]:
    """Layers of the base64 runs. If a run is none from its start on, as other characters precede it, it is decoded in the
    other three steps too, and what is compressed or readable in it is taken."""
    out = []
    for m in _BASE64.finditer(layer.text):
        body = m[0].rstrip("=").translate(_URL_SAFE)
        if len(body) % 4 != 1 and (whole := _decoded(layer, body, m.start(), m.end())):
            out.append(whole)
        else:
            for step in range(4):
                out += _inside(layer, body[step : len(body) - ((len(body) - step) % 4 == 1)], m.start() + step, m.end())
    return out


def _lines(layer: Layer) -> list[Iterator[Layer]]:
    """Layers of base64 that is broken into lines, which are joined for that."""
    out = []
    for m in _BROKEN_LINES.finditer(layer.text) if "\n" in layer.text else ():
        kept = np.ones(len(m[0]), bool)
        for e in _LINE_END.finditer(m[0]):
            kept[e.start() : e.end()] = False
        place = np.flatnonzero(kept)
        out += _blobs(layer.derived("".join(m[0][k] for k in place.tolist()), "lines", m.start() + place, m.start() + place))
    return out


def _byte_pieces(text: str, start: int, written: re.Pattern) -> Iterator[bytes]:
    """The bytes that a text writes out from start on, up to a character that is none."""
    at, size = start, _AT_FIRST
    while at < len(text):
        out, high = bytearray(), min(len(text), at + size)
        size = min(2 * size, _AT_MOST)
        while at < high and (m := written.match(text, at)):
            out.append(_byte(m))
            at = m.end()
        if out:
            yield bytes(out)
        if at < high:
            return


def _byte(m: re.Match) -> int:
    if m[2]:
        return ord(m[2])
    return int(m[1], 16) if m[1] else int(m[3], 16) if m[3] else ord(_NAMED[m[4]])


def _streams_in(layer: Layer) -> list[Iterator[Layer]]:
    """Layers of compressed streams whose bytes are written out in the text, as %XX, as escapes, or as characters."""
    out, behind = [], 0
    for m in _STREAM.finditer(layer.text) if any(x in layer.text for x in _HINTS) else ():
        for written in (_AS_PERCENT,) if "%" in m[0] else (_AS_ESCAPES,) if "\\" in m[0] else (_AS_CHARACTERS, _AS_ESCAPES):
            if m.start() >= behind and (squeezed := _inflated(_byte_pieces(layer.text, m.start(), written))):
                behind = _stream_end(layer.text, m.start(), written)
                out.append(_unwrapped(squeezed, f"{layer.via}>bytes", *layer.source(m.start(), behind)))
    return out


def _stream_end(text: str, start: int, written: re.Pattern) -> int:
    """The character behind the first stream whose bytes are written out from start on."""
    taken = 0
    for magic, _, new in _PACKED:
        pieces = _byte_pieces(text, start, written)
        if not (data := next(pieces)).startswith(magic):
            continue
        unpack, taken = new(), len(data)
        try:
            while not unpack.eof:
                if not data and getattr(unpack, "needs_input", True):
                    if not (data := next(pieces, b"")):
                        break
                    taken += len(data)
                unpack.decompress(data, PIECE)
                data = getattr(unpack, "unconsumed_tail", b"")
        except _BROKEN:
            continue
        taken -= len(unpack.unused_data)
        break
    at = start
    for _ in range(taken):
        at = written.match(text, at).end()
    return at


def _plain(body: str) -> bytes:
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _text_layer(layer: Layer, text: str, kind: str, start: int, skip: int, end: int) -> Iterator[Layer]:
    """A layer of text that begins `skip` bytes into what the characters from start on decode to, of which none lies beyond end."""
    high = skip + np.cumsum([len(c.encode(kind)) for c in text])
    low = np.concatenate([[skip], high[:-1]])
    return iter([layer.derived(text, "base64", start + low * 4 // 3, np.minimum(start - 1 - -high * 4 // 3, end - 1))])


def _decoded(layer: Layer, body: str, start: int, end: int) -> Iterator[Layer] | None:
    """The layers of a whole run, if it is a compressed stream or readable."""
    raw = _plain(body)
    if squeezed := _inflated(iter([raw])):
        return _unwrapped(squeezed, f"{layer.via}>base64", *layer.source(start, end))
    if found := _readable(raw):
        return _text_layer(layer, *found, start, 0, start + len(body))
    return _deflated(layer, raw, start, end)


def _deflated(layer: Layer, raw: bytes, start: int, end: int) -> Iterator[Layer] | None:
    """The layers of a raw deflate stream, which nothing marks: it has to end where the bytes end."""

    def pieces() -> Iterator[bytes]:
        unpack, data = zlib.decompressobj(-15), raw
        while not unpack.eof:
            out = unpack.decompress(data, PIECE)
            data = unpack.unconsumed_tail
            if out:
                yield out
            elif not data and not unpack.eof:
                raise EOFError
        if len(unpack.unused_data) > 2:  # what a last group of base64 may have beyond it
            raise EOFError

    try:
        size = sum(map(len, pieces()))
    except _BROKEN:
        return None
    return _unwrapped(("deflate", pieces()), f"{layer.via}>base64", *layer.source(start, end)) if size else None


def _inside(layer: Layer, body: str, start: int, end: int) -> Iterator[Iterator[Layer]]:
    """The layers of what is compressed or readable in a run."""
    raw = _plain(body)
    if deflated := _deflated(layer, raw, start, end):
        yield deflated
    for m in _MAGIC.finditer(raw):
        if squeezed := _inflated(iter([raw[m.start() :]])):
            yield _unwrapped(squeezed, f"{layer.via}>base64", *layer.source(start + m.start() * 4 // 3, end))
    for m in _PRINTABLE.finditer(raw):
        yield _text_layer(layer, m[0].decode("utf-8", "replace"), "utf-8", start, m.start(), start + len(body))


def _unwrapped(squeezed: tuple[str, Iterator[bytes | None]], via: str, low: int, high: int) -> Iterator[Layer]:
    """Layers of a compressed blob with the span from low to high, made as they are scanned."""
    while squeezed:
        name, pieces = squeezed
        via = f"{via}>{name}"
        pieces, ahead = tee(pieces)
        squeezed = _inflated(ahead)
        if squeezed:
            del pieces
    del ahead
    for raw in _parts(pieces):
        if inner := _inflated(iter([raw])):
            yield from _unwrapped(inner, via, low, high)
        elif (text := _readable(raw, len(raw) > LAYER_BYTES)) is not None:
            yield Layer(text[0], via, span=(low, high))


def find(text: str) -> list[dict]:
    """All findings of a text: those of the base patterns, and those in layers that decoding unwraps."""
    found: dict[tuple[str, int, int], dict] = {}
    work, seen = deque([iter([Layer(text, "text")])]), set()
    while work:
        if (layer := next(work[0], None)) is None:
            work.popleft()
            continue
        # Long layers are remembered by a digest, so that no more than one part of them is held.
        mark = layer.text if len(layer.text) < 1 << 16 else blake2b(layer.text.encode("utf-8", "surrogatepass")).digest()
        whole = (layer.source(0, len(layer.text)), mark) if layer.text else None
        if whole is None or whole in seen:
            continue
        seen.add(whole)
        for kind, start, end in base_spans(layer.text):
            span = (kind, *layer.source(start, end))
            found.setdefault(span, {"kind": kind, "start": span[1], "end": span[2], "base": layer.is_document, "via": layer.via, "value": layer.text[start:end]})
        work.extend([iter([x]) for x in (_percent(layer), _escapes(layer)) if x] + _blobs(layer) + _lines(layer) + _streams_in(layer))
    return ordered(list(found.values()), KINDS)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, findings) for each row of docs(doc_id, text, ...).

    A worklist starts with the text. Each layer is scanned with the base patterns, then unwrapped: runs of %XX and of
    Unicode escapes are decoded in place, base64 (and its URL-safe form) of 16 characters or more becomes a layer of
    its own if it holds readable text (UTF-8, UTF-16 or Latin), a raw deflate stream, or gzip, zlib, bz2 or xz streams of
    such, one after another and of any length; base64 that is broken into lines is joined for that. Compressed streams
    whose bytes a text writes out as %XX, as escapes or as characters are layers too. Where characters that stand before the base64 belong to its alphabet too, as in a path, the run is
    decoded in all four steps. Hexadecimal and HTML entities are no layers. Parts
    of LAYER_BYTES that overlap by OVERLAP are scanned of a longer one, so that only a longer run can be cut. New layers join the list until none
    is left; a layer that was seen with the same span is not taken twice, which ends cycles. A finding's start and end
    are the code points of the document behind it; in a compressed layer that is the whole blob. Findings are ordered
    by start, then kind.

    Null is the empty text, which has no findings. Whole texts are scanned at any length. Repeated rows give a row
    each. Extra columns are ignored; an empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "findings": [find(t) for t in batch.column("text").to_pylist()]}

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), run, f"doc_id long, findings array<{FINDING}>")
