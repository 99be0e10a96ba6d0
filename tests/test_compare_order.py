import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablesmith.operators import compare, html_functions, merge, ordering, standings
from tablesmith.sources import sinks


def test_numbers_of_many_names_need_no_single_task(spark):
    names = spark.range(100_000).select(F.sha1(F.col("id").cast("string")).alias("name"), F.col("id").alias("number"))
    out = ordering.numbered(names, ["name"], ranges=16)
    assert out.columns == ["name", "number"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    got = [r["name"] for r in out.orderBy("number").collect()]
    assert got == sorted(got) and out.agg(F.countDistinct("number"), F.min("number"), F.max("number")).first()[:] == (100_000, 1, 100_000)


def test_numbers_of_ties_nulls_and_nothing(spark):
    rows = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("b", 1), ("a", 1)], "by0 string, row int")
    got = sorted((r["k"], r["by0"], r["row"]) for r in ordering.numbered(rows, ["by0", "row"], "k", 3).collect())
    assert got == [(1, None, 2), (2, "a", 1), (3, "a", 3), (4, "b", 1), (5, "b", 1)]
    assert ordering.numbered(rows.limit(0), ["row"]).count() == 0
    assert standings.club_ids(spark.createDataFrame([(None, " "), ("b", "a ")], "home string, visitor string")).orderBy("id").collect() == [("club_1", "a"), ("club_2", "b")]


def brute_diff(a, b):
    gone, come = Counter(a) - Counter(b), Counter(b) - Counter(a)
    out = Counter()
    for key in {r[:3] for r in [*gone, *come]}:
        before, after = [r for r in gone if r[:3] == key], [r for r in come if r[:3] == key]
        g, c = sum(gone[r] for r in before), sum(come[r] for r in after)
        fields = tuple(n for n, k in (("note", 4), ("pos", 3)) if {r[k] for r in before} != {r[k] for r in after})
        for change, f, n in (("changed", fields, min(g, c)), ("removed", None, g - min(g, c)), ("added", None, c - min(g, c))):
            if n:
                out[(*key, change, f, n)] += 1
    return out


def test_differences_equal_brute_force(spark):
    rng = random.Random(2)
    pick = lambda: (rng.choice(["1950", "1951", "1952", None]), rng.choice(["tier1", "tier2"]), rng.choice(["A", "B", None]), rng.choice([1.0, 2.0, None]), rng.choice([None, "", "x"]))
    same = [("1999", "tier1", "Z", 1.0, None)] * 3
    a = same + [pick() for _ in range(120)]
    b = same[::-1] + [r for r in a[3:] if rng.random() < 0.7] + [pick() for _ in range(30)]
    schema = "season_key string, tier_key string, team string, pos double, note string"
    left, right = (spark.createDataFrame(x, schema).withColumn("row_ord", F.monotonically_increasing_id()) for x in (a, b))
    got = Counter((r["season_key"], r["tier_key"], r["team"], r["change"], None if r["fields"] is None else tuple(r["fields"]), r["copies"]) for r in compare.diff(left, right).collect())
    assert got == brute_diff(a, b)
    assert compare.diff(left, left).count() == 0
    with pytest.raises(ValueError, match="different columns"):
        compare.diff(left, right.drop("note"))


@pytest.mark.parametrize("include_empty", [True, False])
def test_the_merge_is_a_fold_over_ranks(spark, include_empty):
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(200):
        sources = sorted(rng.sample(range(9), rng.randrange(1, 7)))
        held = [(rank, rng.random() < 0.5) for rank in sources]
        at = held[0]
        for x in held[1:]:
            if (x[1] and not at[1]) or (not x[1] and include_empty):
                at = x
        tier = rng.choice(["tier1", "seasonInfo"])
        want[str(k), tier] = at[0] if tier == "tier1" else held[0][0]
        rows += [(str(k), tier, rank, data) for rank, data in held]
    rng.shuffle(rows)
    out = merge.first_wins(spark.createDataFrame(rows, "season_key string, tier_key string, source_rank int, data boolean").repartition(5), include_empty)
    assert {(r["season_key"], r["tier_key"]): r["source_rank"] for r in out.collect()} == want
    assert "collect_list" not in out._jdf.queryExecution().toString()


def test_csv_files_keep_the_order_of_rows(spark, tmp_path):
    rows = spark.range(5000).select(F.when(F.col("id") % 10 == 0, 2).otherwise(1).alias("tier"), (1888 + F.col("id") / 50).cast("int").cast("string").alias("Season"), F.col("id").alias("n"), F.lit("f").alias("file"), F.col("id").alias("row_ord")).repartition(6)
    sinks.save_by_tier(rows, str(tmp_path / "tiers"), ("file", "row_ord"), rows_a_file=300)
    sinks.save_chunks(rows, str(tmp_path / "chunks"), 25, ("file", "row_ord"))
    for folder, count in ((tmp_path / "tiers" / "tier=1", 4500), (tmp_path / "tiers" / "tier=2", 500)):
        texts = [p.read_text().splitlines() for p in sorted(folder.glob("*.csv"))]
        assert all(t[0] == "Season,n" and len(t) <= 301 for t in texts)
        numbers = [int(x.split(",")[1]) for t in texts for x in t[1:]]
        assert numbers == sorted(numbers) and len(numbers) == count
    assert len(list((tmp_path / "tiers" / "tier=1").glob("*.csv"))) >= 15
    numbers = [int(x.split(",")[1]) for p in sorted((tmp_path / "chunks" / "tier=2" / "chunk=1888-1912").glob("*.csv")) for x in p.read_text().splitlines()[1:]]
    assert numbers == list(range(0, 1250, 10))


def test_carried_cells(spark):
    rows = spark.createDataFrame([(1, 1, "a", 2), (1, 2, None, None), (1, 3, None, None), (1, 4, "b", 3), (1, 5, "c", 1), (1, 6, None, None), (2, 1, None, None), (None, 1, "d", 9), (None, 3, None, None)], "t int, k int, v string, s int")
    got = {(r["t"], r["k"]): r["x"] for r in rows.select("*", standings.carried(["t"], ["k"], "v", "s").alias("x")).collect()}
    assert got == {(1, 1): "a", (1, 2): "a", (1, 3): None, (1, 4): "b", (1, 5): "c", (1, 6): None, (2, 1): None, (None, 1): "d", (None, 3): "d"}


def test_table_functions_take_null_pages(spark):
    html_functions.register(spark)
    spark.createDataFrame([(1, None), (2, ""), (3, "<pre>a</pre><p><pre>b</pre>")], "id int, html string").createOrReplaceTempView("odd_pages")
    assert sorted(map(tuple, spark.sql("select id, block_no, text from odd_pages, lateral parse_blocks(html)").collect())) == [(3, 0, "a"), (3, 1, "b")]
    assert spark.sql("select * from odd_pages, lateral parse_division(html)").count() == spark.sql("select * from odd_pages, lateral parse_overview(html)").count() == 0
    assert [r["season"] for r in spark.sql("select id, season from odd_pages, lateral parse_infobox(html)").collect()] == ["", "", ""]
