from tablesmith.operators import merge
from tablesmith.operators.dataset import RAW, replace
from tablesmith.sources import datasets
from tablesmith.streaming.seasons import upsert_stream


def test_stream_replaces_seasons(spark, tmp_path):
    source, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    for team in ("A", "B"):
        spark.createDataFrame([(0, "1950", 0, "tier1", 0, f'[{{"team": "{team}"}}]')], RAW).write.mode("append").parquet(source)
        upsert_stream(spark.readStream.schema(RAW).parquet(source), out, mark).awaitTermination()
        assert [r["team"] for r in spark.read.parquet(out).collect()] == [team]


def test_last_source_wins_whole_seasons(spark):
    one = datasets.from_literal(spark, '{"1950": {"tier1": [{"team": "A"}], "tier2": [{"team": "B"}]}, "1951": {"tier1": [{"team": "C"}]}}')
    two = datasets.from_literal(spark, '{"seasons": {"1950": {"tier1": [{"team": "D"}]}}}')
    got = {(r["season_key"], r["tier_key"], r["team"]) for r in merge.overwrite([one, two]).entries.collect()}
    assert got == {("1950", "tier1", "D"), ("1951", "tier1", "C")}
    by_tier = {(r["season_key"], r["tier_key"], r["team"]) for r in replace(one, two).entries.collect()}
    assert by_tier == {("1950", "tier1", "D"), ("1950", "tier2", "B"), ("1951", "tier1", "C")}
