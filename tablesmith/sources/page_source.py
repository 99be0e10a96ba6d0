"""Pages as a data source: spark.read.format("pages"), and as a stream of a growing list of addresses.

Options: `list`, a text file with an address a line, or `urls`, addresses parted by line feeds; `known`, a Parquet folder
(url, html) of pages that need no fetching, which is also what is read if no addresses are named; `fetcher`, as
module:function, a Fetcher; `persecond` and `burst`, how many pages of a host are asked for; `retries` and `pause`, how
often and after how many seconds (doubling) a failed page is asked for again.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.error import HTTPError
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import compute as pc
from pyarrow import dataset, fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from tablesmith.sources.pages import Fetcher, charset, decode, http_fetcher

SCHEMA = "url string, host string, html string, error string"
_ARROW = pa.schema([(name, pa.string()) for name in ("url", "host", "html", "error")])


def host_of(url: str) -> str:
    try:
        return (urlsplit(url).hostname or "").lower()
    except ValueError:
        return ""


class TokenBucket:
    """Lets `burst` askers pass at once and then `rate` of them a second."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], object] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = float(burst), clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            self.at += (1 - self.tokens) / self.rate
            self.tokens = 1.0
        self.tokens -= 1


def lasting(error: Exception) -> bool:
    """Whether asking again is no use: the server's answer is that there is no such page."""
    return isinstance(error, HTTPError) and 400 <= error.code < 500 and error.code not in (408, 429)


def ask(fetcher: Fetcher, url: str, bucket: TokenBucket, retries: int = 2, pause: float = 1.0) -> tuple[str | None, str | None]:
    """(html, error) of a page; each asking takes a token, and all but the first wait as well."""
    for k in range(retries + 1):
        bucket.take()
        try:
            raw, kind = fetcher(url)
            return decode(raw, charset(kind)), None
        except Exception as e:
            if k == retries or lasting(e):
                return None, str(e) or type(e).__name__
        bucket.sleep(pause * 2**k)
    return None, "not asked"


@dataclass
class KnownPart(InputPartition):
    """One file of known pages, and which of its pages are wanted (None: all)."""

    path: str
    urls: list[str] | None


@dataclass
class HostPart(InputPartition):
    """Pages of one host, asked for one after another."""

    host: str
    urls: list[str]


@dataclass
class Settings:
    """Options as values; they go to the tasks."""

    options: dict[str, str]
    wanted: list[Filter] = field(default_factory=list)

    def named(self) -> list[str] | None:
        """Addresses of the options in order, each once; None if none are named."""
        if "list" in self.options:
            system, path = fs.FileSystem.from_uri(self.options["list"]) if "://" in self.options["list"] else (fs.LocalFileSystem(), self.options["list"])
            with system.open_input_stream(path) as file:
                text = file.read().decode()
        elif "urls" in self.options:
            text = self.options["urls"]
        else:
            return None
        return list(dict.fromkeys(x.strip() for x in text.splitlines() if x.strip()))

    def passes(self, url: str) -> bool:
        values = {("url",): url, ("host",): host_of(url)}
        for f in self.wanted:
            value = values[f.attribute]
            if not (value == f.value if isinstance(f, EqualTo) else value in f.value if isinstance(f, In) else value.startswith(f.value)):
                return False
        return True

    def known(self) -> dataset.Dataset | None:
        return dataset.dataset(self.options["known"], format="parquet") if "known" in self.options else None

    def parts(self, named: list[str] | None) -> list[InputPartition]:
        """A part for each file of known pages, and one for each host of the others."""
        known = self.known()
        urls = None if named is None else [u for u in named if self.passes(u)]
        out: list[InputPartition] = []
        have: set[str] = set()
        if known is not None:
            if urls is not None:
                have = set(known.to_table(columns=["url"], filter=pc.field("url").isin(urls) & ~pc.field("html").is_null())["url"].to_pylist())
            if urls is None or have:
                out += [KnownPart(f, None if urls is None else sorted(have)) for f in known.files]
        hosts: dict[str, list[str]] = {}
        for u in urls or ():
            if u not in have:
                hosts.setdefault(host_of(u), []).append(u)
        return out + [HostPart(h, us) for h, us in sorted(hosts.items())]

    def rows(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(part, KnownPart):
            own = dataset.dataset(part.path, format="parquet", filesystem=self.known().filesystem)
            condition = None if part.urls is None else pc.field("url").isin(part.urls)
            for batch in own.to_batches(columns=["url", "html"], filter=condition):
                keep = [k for k, u in enumerate(batch["url"].to_pylist()) if u is not None and self.passes(u)]
                some = batch.take(pa.array(keep, pa.int64()))
                hosts = [host_of(u) for u in some["url"].to_pylist()]
                yield pa.RecordBatch.from_arrays([some["url"].cast(pa.string()), pa.array(hosts, pa.string()), some["html"].cast(pa.string()), pa.nulls(len(keep), pa.string())], schema=_ARROW)
            return
        module, _, name = self.options.get("fetcher", "").partition(":")
        fetcher = getattr(importlib.import_module(module), name) if module else http_fetcher()
        bucket = TokenBucket(float(self.options.get("persecond", 1)), int(self.options.get("burst", 1)))
        for url in part.urls:
            html, error = ask(fetcher, url, bucket, int(self.options.get("retries", 2)), float(self.options.get("pause", 1)))
            yield pa.RecordBatch.from_pylist([{"url": url, "host": part.host, "html": html, "error": error}], schema=_ARROW)


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.settings = Settings(options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Conditions on address and host decide what is fetched; all others are left to Spark."""
        for f in filters:
            if isinstance(f, EqualTo | In | StringStartsWith) and f.attribute in (("url",), ("host",)):
                self.settings.wanted.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return self.settings.parts(self.settings.named())

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.settings.rows(partition)


class PageStreamReader(DataSourceStreamReader):
    """A list that grows at its end; the offset is the number of its addresses that are read."""

    def __init__(self, options: dict[str, str]):
        self.settings = Settings(options)

    def initialOffset(self) -> dict:
        return {"read": 0}

    def latestOffset(self) -> dict:
        return {"read": len(self.settings.named() or ())}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.settings.parts((self.settings.named() or [])[start["read"] : end["read"]])

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.settings.rows(partition)


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))

    def streamReader(self, schema) -> PageStreamReader:
        return PageStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, which then hands conditions down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageSource)
