import random

import numpy as np
import pyarrow as pa

from tablesmith.llm import decontaminate
from tests.llm.test_decontaminate import WORDS, brute


def found(docs, items, rest=True):
    out = decontaminate._search(decontaminate.index(items), 0.8, rest)(pa.RecordBatch.from_pydict({"doc_id": list(range(len(docs))), "text": pa.array(docs, pa.large_string())}))
    return {(d, i): s for d, i, s in zip(out["doc_id"], out["item_id"], out["similarity"])}


def test_cut_item_among_longer_items_is_found():
    rng = random.Random(3)
    items = [(k, " ".join(rng.choice(WORDS) + "xyz" for _ in range(n + 4))) for k, n in enumerate([100, 102, 105, 108])]
    cut = " ".join(items[0][1].split()[:84])
    got = found(["", cut, "one"], items)
    assert brute(cut, items[0][1]) >= 0.8 or brute(" ".join(items[0][1].split()[:86]), items[0][1]) >= 0.8
    longer = [" ".join(items[0][1].split()[:n]) for n in range(84, 104)]
    want = {(d, 0) for d, text in enumerate(longer) if brute(text, items[0][1]) >= 0.8}
    assert set(found(longer, items)) == want and len(want) > 15 and set(got) <= {(1, 0)}


def test_no_passage_near_the_threshold_is_lost():
    rng = random.Random(5)
    items = [(k, " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(rng.choice([50, 90, 150, 250])))) for k in range(30)]
    docs = []
    for d in range(900):
        words = items[d % 30][1].split()
        for _ in range(max(1, round(len(words) * 0.022)) if d % 2 else rng.randint(1, 6)):
            words[rng.randrange(len(words))] = "changed"
        around = [rng.choice(WORDS) for _ in range(rng.randint(0, 60))]
        at = rng.randint(0, len(around))
        docs.append(" ".join(around[:at] + words + around[at:]))
    want = {(d, d % 30): s for d, text in enumerate(docs) if (s := brute(text, items[d % 30][1])) >= 0.8}
    got = found(docs, items)
    assert len(want) > 300 and set(want) == set(got) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    alone = found(docs, items, rest=False)
    for low, high, least in ((0.8, 0.85, 0.95), (0.85, 0.9, 0.98), (0.9, 1.01, 0.99)):
        own = [k for k, s in want.items() if low <= s < high]
        assert len(own) > 30 and sum(k in alone for k in own) >= least * len(own)
    assert all(abs(alone[k] - want[k]) < 1e-9 for k in alone)


def test_blocks_lead_to_all_prints_within_the_radius():
    rng = np.random.default_rng(8)
    prints = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    made = [(k, np.array([k], np.uint64), np.array([1], np.uint8), int(p), n) for k, (p, n) in enumerate(zip(prints, sorted(rng.integers(1, 400, 500).tolist())))]
    found = decontaminate.Index(made)
    asked = prints[rng.integers(0, 500, 3000)]
    for _ in range(10):
        asked = np.where(rng.random(3000) < 0.8, asked ^ np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64), asked)
    for group, (low, high) in enumerate(zip(found.bounds, found.bounds[1:])):
        near = np.bitwise_count(asked[:, None] ^ prints[None, low:high]) <= decontaminate.RADIUS
        assert found.hits(group, asked) == [(int(a), int(b) + low) for a, b in np.argwhere(near)]
    sizes = np.array([x[4] for x in made])
    for low, high in zip(found.bounds, found.bounds[1:]):
        assert sizes[high - 1] <= max(sizes[low] + 0.5, decontaminate.ALIKE * sizes[low])


def test_very_long_items_are_searched_whole():
    rng = random.Random(2)
    words = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(9500)]
    cut = list(words)
    for k in range(0, 9500, 400):
        cut[k] = "other"
    docs = [" ".join(["before"] * 30 + cut + ["after"] * 50), " ".join(words[:5000]), "short"]
    got = found(docs, [(1, " ".join(words)), (2, " ".join(words[100:160]))])
    assert set(got) == {(0, 1), (0, 2), (1, 2)} and abs(got[0, 1] - brute_whole(cut, words)) < 0.02


def brute_whole(a, b):
    x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


def test_wide_and_narrow_fingerprints_agree():
    hashes, weights, first, end = decontaminate.weighted_shingles(pa.array([" ".join(random.Random(1).choices(WORDS, k=3000))], pa.large_string()))
    start = np.arange(0, 2000, 100)
    assert (decontaminate.fingerprints(decontaminate.lane_sums(hashes, weights), start, start + 700) == decontaminate.wide_fingerprints(hashes, weights, start, start + 700)).all()
