import random
import zlib
from collections import Counter

import numpy as np

from tablesmith.llm import packing


def test_pieces_are_powers_of_two():
    for n in (1, 2, 1023, 1024, 1025, 5000):
        pieces = packing.decompose(n)
        assert sum(pieces) == n and all(p & (p - 1) == 0 and p <= 1024 for p in pieces) and max(Counter(pieces[pieces.count(1024) :]).values(), default=1) == 1


def test_ids_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    rng = random.Random(3)
    odd = ["", " ", "\n\n\n  \t x", "<|endoftext|> text", "a <|endoftext|> b", "<|endof<|endoftext|>text|><|endoftext|><|endoftext|>  é", "<|startoftext|>", " " * 400_000 + "<|endoftext|>", "é日本🙂‍", "a" * 3000, "don't I'LL 123 4,5.6", "x" + " " * 400 + "y", "\x00\x01\x7f", "#" * 700]
    texts = odd + ["".join(chr(rng.choice([32, 32, 10, *range(97, 123), 233, 0x4E2D, 0x1F600])) for _ in range(rng.randint(0, 400))) for _ in range(60)] + ["word " * 2000]
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate([*texts, None, None])], "doc_id long, text string, length string")
    rows = packing.pack(frame).collect()
    for k, text in enumerate([*texts, "", ""]):
        own = sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["start"])
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own]).tolist() == ids, text[:20]
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist() and all(r["doc_tokens"] == len(ids) and r["offset"] == 0 and r["bucket"] == r["length"] for r in own)
        assert zlib.crc32(own[0]["ids"]) == zlib.crc32(np.array(ids[: own[0]["length"]], "<u4").tobytes())
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_buckets_hold_equal_lengths(spark, tmp_path):
    frame = spark.createDataFrame([(k, "some words of a text " * k) for k in range(80)], "doc_id long, text string")
    pieces = packing.pack(frame)
    rows = sorted(pieces.collect(), key=lambda r: r["sequence_id"])
    assert [r["bucket"] for r in rows] == sorted(r["length"] for r in rows)
    packing.save_by_bucket(pieces, str(tmp_path / "out"))
    for bucket in {r["length"] for r in rows}:
        held = spark.read.parquet(str(tmp_path / "out" / f"bucket={bucket}")).collect()
        assert len(held) == sum(r["length"] == bucket for r in rows) and all(len(r["ids"]) == 4 * bucket for r in held)


def test_a_vocabulary_without_ranks(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(spark.createDataFrame([(1, "Some Words <|endoftext|>")], "doc_id long, text string"), path=path).collect()
    ids = [i for r in sorted(rows, key=lambda r: r["start"]) for i in np.frombuffer(r["ids"], "<u4").tolist()]
    assert ids == [*Tokenizer.from_file(path).encode("Some Words <|endoftext|>", add_special_tokens=False).ids, 0]
