"""N-gram Jaccard join by a MinHash LSH forest, with exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import Stash, map_rows, text_of
from tablesmith.llm.components import components
from tablesmith.llm.sieve import MAYBE, Sieve, without
from tablesmith.llm.words import SIMILARITY, U, chunks, mix, shingles, similar_pairs, utf8

TREES, DEPTH, RECALL, SEED = 24, 10, 0.999, 7
#: Bits of a MinHash value in a label; a text's label in a tree is DEPTH values, the first one in the highest bits.
BITS = 6
#: Texts of one side of a block of pairs.
BLOCK = 512
#: Rows that a text's representative is joined by, as one text may be that of most rows.
SALTS = 16


def recall(prefix: int, trees: int = TREES, similarity: float = SIMILARITY) -> float:
    """Chance that two texts of this similarity share a prefix of this length in some tree."""
    return 1 - (1 - similarity**prefix) ** trees


def matched_prefix(trees: int = TREES, depth: int = DEPTH, similarity: float = SIMILARITY, target: float = RECALL) -> int:
    """The longest prefix, of up to depth values, that reaches the target recall."""
    prefix = depth
    while prefix > 1 and recall(prefix, trees, similarity) < target:
        prefix -= 1
    return prefix


def next_prefix(prefix: int, lowest: float | None, trees: int = TREES, similarity: float = SIMILARITY, target: float = RECALL) -> int | None:
    """How long the matched prefixes are after a round with this prefix; none if the target recall at the threshold is reached.

    lowest is the least similarity of any pair found so far. Prefixes shorten until such pairs are met as surely as the
    target, by one value at least, and never beyond what the threshold asks for.
    """
    if prefix == 1 or recall(prefix, trees, similarity) >= target:
        return None
    floor = matched_prefix(trees, prefix, similarity, target)
    return floor if lowest is None else max(floor, matched_prefix(trees, prefix - 1, lowest, target))


def labels(values: np.ndarray, at: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """One row a text: in each tree its label, of depth MinHash values of BITS bits each."""
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, trees), U)
    if len(full):
        rng = np.random.default_rng(SEED)
        scrambled = np.empty_like(values)
        for tree in range(trees):
            label = np.zeros(len(full), U)
            for _ in range(depth):
                np.multiply(values, U(int(rng.integers(1, 1 << 63)) | 1), out=scrambled)
                label = label << U(BITS) | mix(np.minimum.reduceat(scrambled, at[:-1][full])) >> U(64 - BITS)
            out[full, tree] = label
    return out


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _sign(trees: int, depth: int):
    def run(batch: pa.RecordBatch) -> dict:
        text = batch.column("text")
        keys, counts = [], []
        for i, j in chunks(utf8(text)[1]):
            values, at = shingles(text[i:j])
            keys.append(labels(values, at, trees, depth))
            counts.append(np.diff(at))
        counts, keys = np.concatenate(counts), np.concatenate(keys)
        offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, trees, 0))])
        flat = _signed(keys[counts > 0].reshape(-1))
        return {"doc_id": batch.column("doc_id"), "k1": batch.column("k1"), "k2": batch.column("k2"), "labels": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))}

    return run


def _owned(marks: np.ndarray, a: np.ndarray, b: np.ndarray, tree: int, short: int, long: int | None) -> np.ndarray:
    """Whether this tree is the first one in which both texts share a node; if they share a longer prefix anywhere, they have been compared before."""
    same = marks[a] ^ marks[b]
    mine = ~(same[:, :tree] >> U(short) == 0).any(1)
    return mine if long is None else mine & ~(same >> U(long) == 0).any(1)


def _verify(threshold: float, short: int, long: int | None):
    """Links within the blocks of a node's texts. short, long: bits below the prefix of this round and of the one before."""

    def block(rows: list[tuple[int, int, str, list[int]]], tree: int, i: int, j: int) -> pa.RecordBatch:
        rows = sorted({r[:3]: r for r in rows}.values(), key=lambda r: (r[1] != i, r[0], r[2]))
        ids = np.array([r[0] for r in rows], np.int64)
        values, at = shingles(pa.array([r[2] for r in rows], pa.large_string()))
        cross = sum(r[1] == i for r in rows) if i != j else 0
        a, b, similarity = similar_pairs([values[at[k] : at[k + 1]] for k in range(len(rows))], cross, threshold)
        if i != j and (not cross or cross == len(rows)):
            a, b, similarity = a[:0], b[:0], similarity[:0]
        mine = _owned(np.array([r[3] for r in rows], np.int64).view(U), a, b, tree, short, long)
        a, b, similarity = a[mine], b[mine], similarity[mine]
        ends, least = np.concatenate([a, b]), np.full(len(rows), 2.0)
        np.minimum.at(least, ends, np.concatenate([similarity, similarity]))
        links, label = np.bincount(ends, minlength=len(rows)), np.arange(len(rows))
        while True:
            new = label.copy()
            np.minimum.at(new, a, label[b])
            np.minimum.at(new, b, label[a])
            new = new[new]
            if (new == label).all():
                break
            label = new
        some = links > 0
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[label[some]]), pa.array(links[some].astype(np.int64)), pa.array(least[some])], ["src", "dst", "links", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for tree, node, i, j, *row in zip(*(batch.column(c).to_pylist() for c in ("tree", "node", "i", "j", "doc_id", "chunk", "text", "labels"))):
                if (tree, node, i, j) != now:
                    if len(rows) > 1:
                        yield block(rows, now[0], *now[2:])
                    now, rows = (tree, node, i, j), []
                rows.append(tuple(row))
        if len(rows) > 1:
            yield block(rows, now[0], *now[2:])

    return run


def _representatives(signed: DataFrame, stash: Stash) -> DataFrame:
    """(doc_id, k1, rep_id): the least doc_id of each row's text. Only rows whose text may occur twice are joined, by salted keys."""
    copied = signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep_id"), F.count("*").alias("n")).filter("n > 1").select("k1", "k2", "rep_id")
    copied = stash(copied)
    both = Sieve(copied, "k1").split(signed.select("doc_id", "k1", "k2"), "k1")
    clear = both.filter(f"not {MAYBE}").select("doc_id", "k1", F.col("doc_id").alias("rep_id"))
    salted = copied.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = both.filter(MAYBE).withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.lit(SALTS)).cast("int")).join(salted, ["k1", "k2", "salt"], "left")
    return stash(clear.unionAll(met.select("doc_id", "k1", F.coalesce("rep_id", "doc_id").alias("rep_id"))))


def _branches(signed: DataFrame, members: DataFrame, prefix: int, depth: int, stash: Stash) -> DataFrame:
    """(tree, label, doc_id): the tries' branches below nodes of this prefix that two different texts share."""
    own = F.xxhash64("doc_id", "k1").alias("own")
    copies = stash(members.filter("doc_id <> rep_id").select(own).distinct())
    listed = without(signed.filter("doc_id is not null").select("doc_id", "labels", own), copies, "own")
    nodes = listed.select("doc_id", F.posexplode("labels").alias("tree", "label"))
    key = F.xxhash64("tree", F.shiftrightunsigned("label", BITS * (depth - prefix))).alias("key")
    crowded = stash(nodes.groupBy(key).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low <> high").select("key"))
    return stash(Sieve(crowded, "key").keep(nodes.select("*", key), "key").join(crowded, "key").select("tree", "label", "doc_id").distinct())


def _round(branches: DataFrame, texts: DataFrame, threshold: float, depth: int, prefix: int, before: int | None) -> DataFrame:
    """(src, dst, links, least) of the pairs that share a node of this prefix and none of the longer prefix of the round before."""
    short = BITS * (depth - prefix)
    long = None if before is None else BITS * (depth - before)
    placed = branches.select("tree", F.shiftrightunsigned("label", short).alias("node"), F.shiftrightunsigned("label", long or 0).alias("deeper"), "doc_id")
    new = F.count("*") > 1 if before is None else F.min("deeper") != F.max("deeper")
    # Nodes of the same texts need one look, in the first tree that has such a node: they have the same number of texts and checksums.
    sums = [F.expr(f"bit_xor(xxhash64(doc_id, {k}))").alias(f"sum{k}") for k in (1, 2)]
    nodes = placed.groupBy("tree", "node").agg(F.count("*").alias("n"), *sums, new.alias("new")).filter("new")
    nodes = nodes.groupBy("n", "sum1", "sum2").agg(F.min(F.struct("tree", "node")).alias("at")).select("at.tree", "at.node", F.ceil(F.col("n") / BLOCK).cast("int").alias("m"))
    dealt = (
        placed.select("tree", "node", "doc_id").join(nodes, ["tree", "node"])
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("m")).cast("int"))
        .hint("merge").join(texts, "doc_id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .select("tree", "node", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "doc_id", "chunk", "text", "labels")
        .repartition("tree", "node", "i", "j")
        .sortWithinPartitions("tree", "node", "i", "j")
    )
    return dealt.mapInArrow(_verify(threshold, short, long), "src long, dst long, links long, least double")


def jaccard_join(docs: DataFrame, threshold: float = SIMILARITY, trees: int = TREES, depth: int = DEPTH, target: float = RECALL) -> DataFrame:
    """Near-duplicate classes of docs(doc_id, text, ...) on five-word shingles: (doc_id, class_id, rep_id, n_links).

    Texts that are equal are one class from the start, represented by their least doc_id (rep_id). Each different text
    gets a label of depth MinHash values in each of the trees, which are tries of such labels. Rounds begin with whole
    labels and shorten the matched prefix: in each round the texts of every node of that prefix are compared, all
    pairs in blocks of 512 x 512 texts, but for pairs that a longer prefix or an earlier tree has led to. How far the
    prefix shortens depends on the least similar pair found so far (next_prefix); the last one is that whose recall at
    the threshold is the target. Only link counts and a spanning forest of a block leave its task.
    class_id is the least doc_id of the linked texts, n_links how many different texts are as similar as the threshold.

    Null is the empty text. A text without words links to nothing and only equals other such texts' copies; one of
    fewer than five words has a single shingle. Rows that repeat a doc_id with the same text give one row each; with
    different texts they are one node, with the links of both. A row without a doc_id is no node, as nothing could name
    it in a link: it is in the class of the rows of its text that have one, else in none (class_id and rep_id null, no
    links), and it gives others no link. Extra columns are ignored. An empty table gives no rows.
    """
    if depth * BITS > 60:
        raise ValueError(f"labels have {60 // BITS} values at most")
    spark = docs.sparkSession
    stash = Stash(spark, "jaccard")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    keyed = texts.select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("second"), "text").alias("k2"))
    signed = stash(map_rows(keyed, _sign(trees, depth), "doc_id long, k1 long, k2 long, labels array<long>"), plain=True)
    members = _representatives(signed, stash)
    branches = _branches(signed, members, matched_prefix(trees, depth, threshold, target), depth, stash)
    wanted = stash(branches.select("doc_id").distinct())
    own = Sieve(wanted, "doc_id").keep(signed.select("doc_id", "labels"), "doc_id").join(wanted, "doc_id").dropDuplicates(["doc_id", "labels"])
    held = stash(Sieve(wanted, "doc_id").keep(texts, "doc_id").distinct().hint("merge").join(own, "doc_id"))
    stash.keep_only(members, branches, held)

    rounds: list[DataFrame] = []
    prefix, before = depth, None
    while prefix:
        rounds.append(stash(_round(branches, held, threshold, depth, prefix, before)))
        found = rounds[0]
        for more in rounds[1:]:
            found = found.unionAll(more)
        prefix, before = next_prefix(prefix, found.agg(F.min("least")).first()[0], trees, threshold, target), prefix
    links = found.groupBy(F.col("src").alias("rep_id")).agg(F.sum("links").alias("n_links"))
    classes = components(found.select("src", "dst"), stash).select(F.col("node").alias("rep_id"), F.col("label").alias("class_id"))
    linked = stash(links.join(classes, "rep_id", "left"))
    stash.keep_only(members, linked)
    both = Sieve(linked, "rep_id").split(members, "rep_id")
    clear = both.filter(f"not {MAYBE}").select("doc_id", F.col("rep_id").alias("class_id"), "rep_id", F.lit(0).cast("long").alias("n_links"))
    salted = linked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = both.filter(MAYBE).withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.lit(SALTS)).cast("int")).join(salted, ["rep_id", "salt"], "left")
    return clear.unionAll(met.select("doc_id", F.coalesce("class_id", "rep_id").alias("class_id"), "rep_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def one_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs without those of a class that are not of its least doc_id; columns stay. Only few rows are shuffled.

    Null texts are empty ones, of which one stays. Rows that repeat a doc_id stay or go together, and rows without one
    stay. An empty table gives an empty one.
    """
    others = Stash(docs.sparkSession, "others")(jaccard_join(docs, **options).filter("doc_id <> class_id").select("doc_id"))
    return without(docs, others, "doc_id")
