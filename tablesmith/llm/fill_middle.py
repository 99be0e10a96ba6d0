"""Fill-in-middle: texts cut at two unit boundaries and put together again with sentinels before their parts.

A table-driven automaton over bytes reads all texts of an Arrow batch in one scan. Its transitions carry counts: a byte
can begin a code point, a word, a line, or end a sentinel. A second pass looks the cuts up in those counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tablesmith.llm.common import map_rows, text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: What a transition can count, as bits: the first byte of a code point, of a word with the white space after it, of a line; the last byte of a sentinel.
COUNTS = {"char": 1, "word": 2, "line": 4, "sentinel": 8}
#: Columns that transform() adds.
RESULTS = "n long, form string, prefix_chars long, middle_chars long, output string"


def _classes() -> np.ndarray:
    """The class of each byte: 0 other ASCII, 1 to 5 the letters of sentinels, 6 white space, 7 line feed, 8 continuation, 9 lead byte."""
    out = np.zeros(256, np.uint8)
    for k, letter in enumerate(b"<PSM>"):
        out[letter] = k + 1
    out[[9, 11, 12, 13, 32]] = 6
    out[10], out[0x80:0xC0], out[0xC0:] = 7, 8, 9
    return out


def _table() -> tuple[np.ndarray, np.ndarray]:
    """Next state and counts for state * CLASSES + class. A state is 3 * (letters of a sentinel read) + (0 in a word, 1 in white space, 2 after a line feed).

    Classes from 10 on are those of a text's first byte, which begins units of every kind whatever came before.
    """
    after, counts = np.zeros((9, 20), np.uint8), np.zeros((9, 20), np.uint8)
    for state in range(9):
        for cls in range(20):
            byte, first = cls % 10, cls >= 10
            read, gap = (0, 2) if first else divmod(state, 3)
            read_now = 1 if byte == 1 else 2 if read == 1 and byte in (2, 3, 4) else 0
            gap_now = {6: 1, 7: 2}.get(byte, 0)
            after[state, cls] = 3 * read_now + gap_now
            counts[state, cls] = (
                (byte != 8) * COUNTS["char"]
                | (first or (gap > 0 and gap_now == 0)) * COUNTS["word"]
                | (gap == 2) * COUNTS["line"]
                | (read == 2 and byte == 5) * COUNTS["sentinel"]
            )
    return after.ravel(), counts.ravel()


CLASS = _classes()
NEXT, COUNT = _table()
STATES, CLASSES, START = 9, 20, 2
#: Bytes that are read one after another; stretches of so many bytes are read side by side.
STRETCH = 256
#: Bytes at a stretch's end that are tried from every state: when all lead to one state, the next stretch's first state is known.
LOOK_BACK = 16


def scan(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The counts of each byte's transition; texts begin at starts."""
    symbols = np.zeros(-(-len(data) // STRETCH) * STRETCH, np.uint8)
    symbols[: len(data)] = CLASS[data]
    symbols[starts] += CLASSES // 2
    steps = np.ascontiguousarray(symbols.reshape(-1, STRETCH).T)
    out, state = np.empty_like(steps), _entry_states(steps)
    for k, symbol in enumerate(steps):
        key = state * np.uint8(CLASSES) + symbol
        out[k], state = COUNT[key], NEXT[key]
    return np.ascontiguousarray(out.T).ravel()[: len(data)]


def _entry_states(steps: np.ndarray) -> np.ndarray:
    """The state in which each stretch begins."""
    entry = np.full(steps.shape[1], START, np.uint8)
    for first in (STRETCH - LOOK_BACK, 0):  # from the end, or else through whole stretches
        ends = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], steps.shape[1], 1)
        for symbol in steps[first:]:
            ends = NEXT[ends * np.uint8(CLASSES) + symbol]
        if (ends == ends[0]).all():
            entry[1:] = ends[0, :-1]
            return entry
    for k in range(1, len(entry)):
        entry[k] = ends[entry[k - 1], k - 1]
    return entry


def place(counts: np.ndarray, bit: int, k: int, block: int = 1 << 20) -> int:
    """The byte at which unit k begins; the end of the text if it has no more than k."""
    for start in range(0, len(counts), block):
        found = counts[start : start + block] & bit > 0
        if k < (here := int(np.count_nonzero(found))):
            return start + int(np.flatnonzero(found)[k])
        k -= here
    return len(counts)


def _number(counts: np.ndarray, bit: int) -> int:
    return int(np.count_nonzero(counts & bit))


def transform(docs: DataFrame, unit: str = "char", plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """docs with RESULTS; columns of docs with one of those names are replaced.

    n is the number of units ("char": code points; "word": words with the white space after them; "line": lines). Four
    hashes of doc_id choose the two boundaries and the form, so that a document is cut alike wherever it is read. The
    form is plain (output is the text) for empty texts, texts with a sentinel in them, and those whose third hash leaves
    plain_from or more of 100; else spm if the fourth leaves less than spm_below, else psm. Null texts are empty, a
    null doc_id is hashed as no digits, and repeated rows are all returned, cut alike.
    """
    bit = COUNTS[unit]
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    hashes = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    results = _parse_datatype_string(RESULTS)
    others = [c for c in docs.columns if c not in results.names]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), text_of().alias("text"), *hashes)

    def cut(batch: pa.RecordBatch) -> dict:
        texts = batch["text"].cast(pa.large_string())
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low = int(ends[0])
        held = np.frombuffer(data, np.uint8)[low : int(ends[-1])] if data is not None else np.empty(0, np.uint8)
        ends = ends - low
        counts = scan(held, ends[:-1][ends[:-1] < ends[1:]]) if len(held) else held
        h = [batch[f"h{k}"].to_numpy(zero_copy_only=False) for k in range(1, 5)]
        out: dict[str, list] = {name: [] for name in ("n", "form", "prefix_chars", "middle_chars", "output")}
        for k in range(len(texts)):
            text, seen = held[ends[k] : ends[k + 1]], counts[ends[k] : ends[k + 1]]
            n = _number(seen, bit)
            form, lengths, made = "plain", (None, None), text.tobytes()
            if n and h[2][k] % 100 < plain_from and not (seen & COUNTS["sentinel"]).any():
                form = "spm" if h[3][k] % 100 < spm_below else "psm"
                a, b = sorted(place(seen, bit, int(h[i][k] % (n + 1))) for i in (0, 1))
                lengths = _number(seen[:a], COUNTS["char"]), _number(seen[a:b], COUNTS["char"])
                prefix, middle, suffix = made[:a], made[a:b], made[b:]
                before = (PREFIX, prefix, SUFFIX, suffix) if form == "psm" else (SUFFIX, suffix, PREFIX, prefix)
                made = b"".join(x if isinstance(x, bytes) else x.encode() for x in (*before, MIDDLE, middle))
            for name, value in zip(out, (n, form, *lengths, made), strict=True):
                out[name].append(value)
        return {"row": batch["row"], **out}

    made = map_rows(packed, cut, StructType([packed.schema["row"], *results.fields]))
    return made.select(*[F.col("row").getField(c).alias(c) for c in others], *[F.col(f.name) for f in results.fields])


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    order = F.when(form == "psm", F.array(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2))).otherwise(F.array(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1)))
    return F.when(form == "plain", output).otherwise(F.array_join(order, ""))
