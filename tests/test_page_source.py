import io
from urllib.error import HTTPError

import pytest

from tablesmith.sources import page_source
from tablesmith.sources.page_source import TokenBucket, ask

ASKED = "/tmp/tablesmith_asked"


def served(url):
    """A fetcher that notes what it is asked for; found in a task by its name."""
    with open(ASKED, "a") as out:
        out.write(url + "\n")
    if "down" in url:
        raise OSError("down")
    return f"<p>é {url}".encode("cp1252"), "text/html"


@pytest.fixture
def source(spark):
    page_source.register(spark)
    open(ASKED, "w").close()
    return lambda **options: spark.read.format("pages").options(fetcher="tests.test_page_source:served", persecond="1000", pause="0", **options).load()


def asked():
    return sorted(open(ASKED).read().split())


def test_named_pages_by_host(source):
    urls = [f"http://{h}.org/{k}" for h in ("a", "B", "c") for k in range(3)] + ["no address", "http://a.org/0", "http://c.org/down"]
    df = source(urls="\n".join(urls))
    assert df.rdd.getNumPartitions() == 4
    got = {r["url"]: (r["host"], r["html"], r["error"]) for r in df.collect()}
    assert len(got) == 11 and got["http://B.org/2"] == ("b.org", "<p>é http://B.org/2", None) and got["http://c.org/down"] == ("c.org", None, "down")
    assert asked().count("http://c.org/down") == 3 and asked().count("http://a.org/0") == 1


def test_conditions_decide_what_is_fetched(source):
    urls = "\n".join(f"http://{h}.org/{k}" for h in "abc" for k in range(3))
    df = source(urls=urls).filter("host = 'b.org' and url in ('http://b.org/1', 'http://b.org/2', 'http://a.org/1') and html like '%1'")
    assert [r["url"] for r in df.collect()] == ["http://b.org/1"] and asked() == ["http://b.org/1", "http://b.org/2"]


def test_known_pages_are_not_fetched(spark, source, tmp_path):
    known = str(tmp_path / "known")
    spark.createDataFrame([("http://a.org/0", "<p>kept", 1), ("http://a.org/9", "<p>not asked for", 2), ("http://b.org/0", None, 3), (None, "x", 4)], "url string, html string, n int").repartition(3).write.parquet(known)
    (tmp_path / "list").write_text("http://a.org/0\n\nhttp://b.org/0\n")
    got = {r["url"]: r["html"] for r in source(list=str(tmp_path / "list"), known=known).collect()}
    assert got == {"http://a.org/0": "<p>kept", "http://b.org/0": "<p>é http://b.org/0"} and asked() == ["http://b.org/0"]
    assert {r["url"] for r in source(known=known).filter("host = 'a.org'").collect()} == {"http://a.org/0", "http://a.org/9"}


def test_a_growing_list_is_a_stream(spark, source, tmp_path):
    source(urls="")
    (tmp_path / "list").write_text("http://a.org/0\nhttp://b.org/0\n")
    stream = lambda: spark.readStream.format("pages").options(fetcher="tests.test_page_source:served", persecond="1000", pause="0", list=str(tmp_path / "list")).load()

    def run():
        stream().writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start().awaitTermination()
        return sorted(r["url"] for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == ["http://a.org/0", "http://b.org/0"]
    with open(tmp_path / "list", "a") as out:
        out.write("http://a.org/1\n")
    assert run() == ["http://a.org/0", "http://a.org/1", "http://b.org/0"]
    assert asked() == ["http://a.org/0", "http://a.org/1", "http://b.org/0"]


def test_the_bucket_keeps_the_rate():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    bucket = TokenBucket(2, 3, lambda: now[0], sleep)
    for _ in range(7):
        bucket.take()
    assert slept == [0.5] * 4
    now[0] += 100
    for _ in range(4):
        bucket.take()
    assert slept == [0.5] * 5


def test_failures_are_asked_again_but_for_lasting_ones():
    calls, slept = [], []
    bucket = TokenBucket(1, 100, lambda: 0.0, slept.append)

    def fetcher(url):
        calls.append(url)
        if url == "gone":
            raise HTTPError(url, 404, "not found", {}, io.BytesIO())
        if len(calls) < 3:
            raise OSError("once more")
        return b"ok", ""

    assert ask(fetcher, "x", bucket, 2, 1.0) == ("ok", None) and slept == [1.0, 2.0]
    calls.clear()
    assert ask(fetcher, "gone", bucket)[0] is None and calls == ["gone"]
