import os

import duckdb
import pytest

from tablesmith.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_base_columns_equal_sql(spark, name):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet') union all by name select * from (values (null, null), (-3, ''), (-4, 'x 1.2.3.4.5.6.7.8 a@b.c@d.e +1 (255) 555-8013\n\n \n é'), (null, 'a a a a a')) t(doc_id, text)")
    spark_docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None), (-3, ""), (-4, "x 1.2.3.4.5.6.7.8 a@b.c@d.e +1 (255) 555-8013\n\n \n é"), (None, "a a a a a")], "doc_id long, text string")
    folder = f"/tmp/llm_oracles_{os.getpid()}"
    spark_docs.unionByName(odd, allowMissingColumns=True).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    df = QUERIES[name](spark, folder)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda row: [(v is None, v or 0) if not isinstance(v, str) else v for v in row]
    want = sorted(result.fetchall(), key=key)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b, abs=2e-5) if any(isinstance(v, float) for v in a) else a == b
