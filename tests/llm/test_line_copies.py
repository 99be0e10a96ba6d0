from pyspark.sql import functions as F

from tablesmith.llm import lines
from tests.llm.test_line_shingles import brute

LONG = "a line of some length, which many documents have in common and which is long enough to be cut down, number "


def test_copies_are_signed_once(spark, monkeypatch):
    texts = [(d, "\n".join([f"{LONG}{d % 3}", f"another line of its own, {d * d}", "ab"])) for d in range(300)] + [(7, "row of a repeated doc_id\nab")]
    given, sign = [], lines.signatures

    def counted(rows, *kept):
        given.append(rows.agg(F.count("*"), F.count_distinct("line")).first())
        return sign(rows, *kept)

    monkeypatch.setattr(lines, "signatures", counted)
    out = lines.line_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    rows, different = given[0]
    assert different == len({x for _, text in texts for x in text.split("\n")})
    assert rows < different + 60  # of 902 lines; the filters are of bits, so that some copies may stay
    assert {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in out if r["doc_id"] != 7} == {k: v for k, v in brute(texts).items() if k[0] != 7}


def test_lines_without_a_doc_id_are_signed(spark):
    texts = [(None, f"{LONG}{k % 2}") for k in range(40)] + [(None, f"alone {k}") for k in range(40)]
    rows = lines.line_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert len(rows) == 80 and {r["keep_doc_id"] for r in rows} == {None}


def test_shingles_are_hashed_once(spark):
    signed = lines.signatures(spark.createDataFrame([(LONG * 3,)], "line string"))
    plan = signed._jdf.queryExecution().optimizedPlan().toString()
    # Once, in the rows that are kept, and not in their filter as well.
    assert plan.count("substring(narrow") == 1


def test_shingles_of_all_planes_are_the_same_pieces(spark):
    texts = ["abcdefghij", "abcdefghij😀", "😀abcdefghij", "naïve café über", "naïve café über 😀", "ab", "😀", "x" * 7 + "😀"]
    table = spark.createDataFrame([(t,) for t in texts], "line string").withColumn("h", F.xxhash64("line"))
    hashes = {}
    for r in lines._shingles(table.select("line")).join(table, "h").collect():
        piece = r["line"][r["i"]:r["i"] + lines.SHINGLE]
        assert r["n"] == max(1, len(r["line"]) - lines.SHINGLE + 1)
        assert hashes.setdefault(piece, r["s"]) == r["s"]
    assert len(set(hashes.values())) == len(hashes) == len({t[k:k + 8] for t in texts for k in range(max(1, len(t) - 7))})
