"""Pages: by season, from tables, from files in legacy encodings, or from a fetcher that the caller provides."""

from __future__ import annotations

import re
import time
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.functions.league import overview_slug, promotion_slug, season_labels

DEFAULT_ENCODING = "windows-1252"
DEFAULT_TEMPLATE = "https://www.rsssf.org/engpaul/FLA/{seasonSlug}.html"
WIKI = "https://en.wikipedia.org/wiki/"
WIKI_HTML = "https://en.wikipedia.org/api/rest_v1/page/html/"
#: Bytes that windows-1252 leaves open stand for the control characters of the same number.
OPEN_BYTES = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
_OPEN = {0xDC00 + b: chr(b) for b in OPEN_BYTES}
#: A fetcher gives a page's bytes and content type, or raises.
Fetcher = Callable[[str], tuple[bytes, str]]


def decode(raw: bytes, encoding: str | None = None) -> str:
    """Text of bytes in an encoding (windows-1252 by default), or in UTF-8 where that encoding is unknown."""
    name = (encoding or DEFAULT_ENCODING).lower()
    if name in ("windows-1252", "cp1252", "iso-8859-1", "latin1", "us-ascii", "ascii"):
        # Open bytes turn up as characters that no other byte gives, by way of an error handler that maps them one to one.
        return raw.decode("cp1252", "surrogateescape").translate(_OPEN)
    try:
        return raw.decode(name, "replace")
    except LookupError:
        return raw.decode("utf-8", "replace")


def charset(content_type: str | None) -> str | None:
    m = re.search("charset=([^;]+)", content_type or "", re.I)
    return m[1].strip().lower() if m else None


def http_fetcher(agent: str = "tablesmith") -> Fetcher:
    def fetch(url: str) -> tuple[bytes, str]:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=60) as answer:
            return answer.read(), answer.headers.get("content-type") or ""

    return fetch


def first_of(*fetchers: Fetcher) -> Fetcher:
    """A fetcher that tries others in turn; the last one's failure counts."""
    def fetch(url: str) -> tuple[bytes, str]:
        for k, f in enumerate(fetchers):
            try:
                return f(url)
            except Exception:
                if k == len(fetchers) - 1:
                    raise
        raise ValueError("no fetcher")

    return fetch


def elsewhere(fetcher: Fetcher, start: str, other: str) -> Fetcher:
    """A fetcher that asks for addresses that begin with start under another beginning; it fails for all others."""
    def fetch(url: str) -> tuple[bytes, str]:
        if not url.startswith(start):
            raise ValueError(f"no other address for {url}")
        return fetcher(other + url[len(start) :])

    return fetch


def wiki_fetcher(agent: str = "tablesmith") -> Fetcher:
    """Pages by the service for articles' HTML, else by their own address."""
    plain = http_fetcher(agent)
    return first_of(elsewhere(plain, WIKI, WIKI_HTML), plain)


def season_years(spark: SparkSession, start: int, end: int) -> DataFrame:
    if start > end:
        raise ValueError("the first season is after the last")
    return spark.range(start, end + 1).select(F.col("id").cast("int").alias("season"))


def season_urls(years: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """years(season) with season_slug and url; placeholders in braces are filled in, unknown ones stay."""
    url = F.lit(template)
    labels = season_labels(F.col("season"))
    for name, value in labels.items():
        url = F.replace(url, F.lit("{" + name + "}"), value)
    return years.select("season", labels["seasonSlug"].alias("season_slug"), url.alias("url"))


def promotion_pages(years: DataFrame) -> DataFrame:
    slug = promotion_slug(F.col("season"))
    return years.select("season", slug.alias("slug"), F.concat(F.lit(WIKI), slug).alias("url"))


def overview_pages(years: DataFrame) -> DataFrame:
    slug = overview_slug(F.col("season"))
    return years.select("season", F.col("season").cast("string").alias("season_key"), slug.alias("slug"), F.concat(F.lit(WIKI), slug).alias("url"))


def fetch(pages: DataFrame, fetcher: Fetcher, wait_s: float = 1.0, tasks: int = 1) -> DataFrame:
    """pages(url, ...) with html and error: few tasks, and a wait after each page, to be polite. A failure is a row with its error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html, errors = [], []
            for url in batch.column("url").to_pylist():
                try:
                    raw, kind = fetcher(quote(url, safe=":/?&=%#"))
                    html.append(decode(raw, charset(kind)))
                    errors.append(None)
                except Exception as e:
                    html.append(None)
                    errors.append(str(e) or type(e).__name__)
                time.sleep(wait_s)
            yield batch.append_column("html", pa.array(html, pa.string())).append_column("error", pa.array(errors, pa.string()))

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema), "html string", "error string"])
    return pages.repartition(tasks).mapInArrow(run, schema)


def kept_pages(pages: DataFrame, fetcher: Fetcher, folder: str, wait_s: float = 1.0, each: int = 10, *, done: Callable[[DataFrame], object] | None = None) -> tuple[DataFrame, bool]:
    """pages(url, ...) with html and error, kept in a folder of Parquet as they come; and whether all have come.

    What an earlier run has kept is not fetched again, unless it failed. `each` pages are fetched and written at a time,
    so that a run that fails or is interrupted loses no more than these; an interrupt ends the fetching, and the pages so
    far are returned. Addresses are listed on the driver: at a page a second there are never many. done is called with
    the pages that were kept before, and with each group of pages when it is kept.
    """
    spark = pages.sparkSession
    schema = "url string, html string, error string"
    spark.createDataFrame([], schema).write.mode("append").parquet(folder)
    kept = lambda: spark.read.schema(schema).parquet(folder).groupBy("url").agg(F.max("html").alias("html"), F.max("error").alias("error"))
    left = [r["url"] for r in pages.select("url").distinct().join(kept().filter("html is not null"), "url", "left_anti").orderBy("url").collect()]
    whole = True
    got = lambda: kept().withColumn("error", F.when(F.col("html").isNull(), F.col("error")))
    try:
        if done:
            done(pages.join(got().filter("html is not null"), "url"))
        for k in range(0, len(left), each):
            some = spark.createDataFrame([(u,) for u in left[k : k + each]], "url string")
            fetch(some, fetcher, wait_s).write.mode("append").parquet(folder)
            if done:
                done(pages.join(got().join(some, "url", "left_semi"), "url"))
    except KeyboardInterrupt:
        whole = False
    return pages.join(got(), "url"), whole


def local_pages(spark: SparkSession, paths: str | list[str], encoding: str | None = None) -> DataFrame:
    """(path, html) of files in the given encoding, windows-1252 by default."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode(raw, encoding) for raw in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(texts, pa.string())], ["path", "html"])

    paths = [paths] if isinstance(paths, str) else paths
    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(run, "path string, html string")


def table_pages(pages: DataFrame, have: DataFrame) -> DataFrame:
    """pages(url, ...) with html of have(url, html), a table of pages: the offline source."""
    return pages.join(have.select("url", "html"), "url", "left")
