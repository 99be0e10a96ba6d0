"""Packing by power-of-two decomposition: every sequence is one power-of-two piece of one document."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import map_rows, text_of

SEQUENCE, END = 1024, 0
#: The vocabulary, and the same one as ranks, from which tiktoken encodes four times as fast.
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: sequence_id: the exponent of the bucket's length before a number of this many bits.
NUMBER = 59


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str | None) -> Callable[[str], Sequence[int]]:
    """A text's ids by the vocabulary file at path, added tokens in the text included; ranks: the same vocabulary's ranks, if any."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)

    def slow(text: str) -> Sequence[int]:
        return plain.encode(text, add_special_tokens=False).ids

    if ranks is None:
        return slow
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as file:
        known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    added = {token.content: id_ for id_, token in plain.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens=added)

    def encode(text: str) -> Sequence[int]:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its pattern gives up on very long runs of white space
            return slow(text)

    return encode


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def decompose(n: int, most: int = SEQUENCE) -> list[int]:
    """n as powers of two of at most `most` each, from the longest on."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str | None = None, ranks: str | None = None, most: int = SEQUENCE) -> DataFrame:
    """Pieces of docs(doc_id, text, ...): (doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset).

    A document is its text's ids by the vocabulary file at path (VOCABULARY unless given; ranks: the same vocabulary for
    tiktoken), strings of its added tokens being those tokens, and one end id 0. It is cut from the front into pieces whose lengths are the binary
    decomposition of its length, of at most `most` (a power of two) ids each. Each piece is a sequence of its own
    (offset 0) in the bucket of its length, so that no sequence crosses documents and none is padded. ids holds
    little-endian unsigned 32-bit ids. sequence_id is unique in the result, and those of a bucket are one range of
    numbers, the shortest lengths first; it and the cuts depend on the rows' order in the input alone, so that a task
    that runs again gives the same ones. save_by_bucket writes the sequences of each length together.

    Null is the empty text, whose document is the end id alone. Very long texts give one piece for every `most` ids.
    Repeated rows are documents of their own. Extra columns are ignored; an empty table gives no rows.
    """
    if most & (most - 1):
        raise ValueError("the longest piece must be a power of two")

    def cut(batch: pa.RecordBatch) -> dict:
        encode = encoder(path or vocabulary_path(), ranks or (None if path else vocabulary_path(RANKS)))
        out = {"doc_id": [], "start": [], "length": [], "ids": [], "doc_tokens": []}
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = np.append(encode(text), END).astype("<u4")
            raw, start = ids.tobytes(), 0
            for length in decompose(len(ids), most):
                out["doc_id"].append(doc)
                out["start"].append(start)
                out["length"].append(length)
                out["ids"].append(raw[4 * start : 4 * (start + length)])
                start += length
            out["doc_tokens"] += [len(ids)] * (len(out["start"]) - len(out["doc_tokens"]))
        return out

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    pieces = map_rows(texts, cut, "doc_id long, start long, length long, ids binary, doc_tokens long")
    exponent = F.round(F.log2("length")).cast("long")
    sequence = F.shiftleft(exponent, NUMBER) + F.monotonically_increasing_id()
    return pieces.select("*", F.col("length").alias("bucket"), sequence.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def save_by_bucket(pieces: DataFrame, folder: str) -> None:
    """Write pack()'s rows with the sequences of each length in a folder of their own, bucket=1 to bucket=1024, without a shuffle."""
    pieces.write.partitionBy("bucket").parquet(folder)
