"""Main text of pages by site style trees: the pages of a host are merged branch by branch, and branches that say the same everywhere are noise.

A node of a host's tree is a branch (its labels from the root on). It counts the different ways in which pages fill it:
the sequences of parts below it (presentation), and the texts, links and images in it (content). Its importance is the
entropy of those, between 0 (all pages alike) and 1. A page's blocks are kept or dropped by the importance of the
branches that they stand in.
"""

from __future__ import annotations


import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tablesmith.llm.common import Stash, map_rows
from tablesmith.llm.page_blocks import REAL_MAIN, Page, path_key, read

#: A branch is judged if it is on this many different pages of its host and on this share of them. The share also bounds
#: a host's judged branches: there are at most 1 / SHARE times as many as a page has on average.
LEAST_PAGES, SHARE = 12, 0.02
#: Of the importance of a branch with n parts below it, DAMPING ** n is theirs and the rest its own.
DAMPING = 0.9
#: The share of its branch's importance in a block's.
FROM_BRANCH = 0.2
#: Blocks below these are noise: those in an article's place, which only a text that nearly all pages repeat can be, and others.
NOISE_IN_MAIN, NOISE = 0.15, 0.4
TEXT = "#text"
RESULTS = "text string, n_chars long, n_blocks long, n_beside long, n_noise long"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host(url: Column) -> Column:
    """The url's host in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _places(page: Page) -> list[tuple[int, str]]:
    """(key, text) of each block."""
    return [(path_key(page.keys[b.element], TEXT), b.text()) for b in page.blocks]


def _shapes(page: Page) -> list[list[str]]:
    """The parts below each element, in page order; equal ones that follow each other count once. Blocks come after elements."""
    below: list[list[str]] = [[] for _ in page.parents]
    for e in range(1, len(page.parents)):
        if not page.aside[e]:
            mine = below[page.parents[e]]
            if not mine or mine[-1] != page.labels[e]:
                mine.append(page.labels[e])
    for e in {b.element for b in page.blocks}:
        below[e].append(TEXT)
    return below


def counted(html: str) -> tuple[int, dict[int, int], set[tuple[int, int]]]:
    """(number of what the page says, shape of each branch, contents): what a page adds to its host's tree.

    Branches beside articles by their own names are left out: they go whatever the tree says.
    """
    page = read(html)
    shapes: dict[int, list[str]] = {}
    for e, parts in enumerate(_shapes(page)):
        if not page.aside[e]:
            shapes.setdefault(page.keys[e], []).append(",".join(parts))
    contents, said = set(), []
    for block, (key, text) in zip(page.blocks, _places(page), strict=True):
        if not page.aside[block.element]:
            shapes[key] = [TEXT]
            said.append(text)
            contents.update((key, _hash(x)) for x in (text, *block.features) if x)
    return _hash("\n".join(said)), {k: _hash("|".join(sorted(set(v)))) for k, v in shapes.items()}, contents


def trees(pages: DataFrame, stash: Stash) -> DataFrame:
    """(host, nodes): a map from the key of each judged branch to its importance, for each host that has some.

    Pages of a host that say the same count once, so that copies make no article a template. All counts are sums that
    tasks begin on their side, so a host of any size is spread over all tasks.
    """

    def parts(batch: pa.RecordBatch) -> dict:
        made = [counted(html or "") for html in batch["html"].to_pylist()]
        shapes = [list(m[1].items()) for m in made]
        contents = [sorted(m[2]) for m in made]
        pair = lambda rows: [[{"key": k, "value": v} for k, v in row] for row in rows]
        return {"host": batch["host"], "said": [m[0] for m in made], "shapes": pair(shapes), "contents": pair(contents)}

    rows = "array<struct<key:long,value:long>>"
    each = map_rows(pages.select(host(F.col("url")).alias("host"), "html"), parts, f"host string, said long, shapes {rows}, contents {rows}")
    different = each.filter("host <> ''").dropDuplicates(["host", "said"])
    tagged = F.concat(F.transform("shapes", lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"), F.lit(True).alias("shape"))), F.transform("contents", lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"), F.lit(False).alias("shape"))))
    counts = different.select("host", F.explode(tagged).alias("x")).groupBy("host", "x.key", "x.shape", "x.value").agg(F.count(F.lit(1)).alias("c"))
    total = lambda column, shape: F.sum(F.when(F.col("shape") == shape, column).otherwise(F.lit(0.0)))
    spread = F.col("c") * F.log("c")
    nodes = stash(
        counts.groupBy("host", "key").agg(
            total(F.col("c"), True).cast("long").alias("pages"), total(spread, True).alias("shape_log"), total(F.col("c"), False).alias("contents"), total(spread, False).alias("content_log")
        )
    )
    sizes = nodes.filter("key = 0").select("host", F.col("pages").alias("host_pages"))
    judged = nodes.join(sizes, "host").filter((F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= SHARE * F.col("host_pages")))
    log = F.log("pages")
    importance = F.when(F.col("contents") > 0, 1 - F.col("content_log") / F.col("contents") / log).otherwise(1 - F.col("shape_log") / F.col("pages") / log)
    return stash(judged.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("key", importance.cast("float").alias("importance")))).alias("nodes")))


def branch_importance(page: Page, nodes: dict[int, float]) -> list[float]:
    """Composite importance of each element: its own, and that of what is below it, which weighs the less the more parts there are."""
    n = len(page.parents)
    sums, parts = [0.0] * n, [0] * n
    for block in page.blocks:
        if not page.aside[block.element]:
            sums[block.element] += nodes.get(path_key(page.keys[block.element], TEXT), 1.0)
            parts[block.element] += 1
    out = [0.0] * n
    for e in range(n - 1, -1, -1):
        own = nodes.get(page.keys[e], 1.0)
        below = DAMPING ** parts[e] if parts[e] else 0.0
        out[e] = (1 - below) * own + (below * sums[e] / parts[e] if parts[e] else 0.0)
        if e and parts[e] and not page.aside[e]:
            sums[page.parents[e]] += out[e]
            parts[page.parents[e]] += 1
    return out


def main_text(html: str, nodes: dict[int, float]) -> tuple[str, int, int, int]:
    """(text, blocks kept, blocks beside articles, noise by the tree) of a page."""
    page = read(html)
    composite = branch_importance(page, nodes)
    places = _places(page)
    wanted = max((page.main[b.element] for b, (_, text) in zip(page.blocks, places, strict=True) if text), default=0)
    kept, beside, noise = [], 0, 0
    for block, (key, text) in zip(page.blocks, places, strict=True):
        e = block.element
        if not text:
            continue
        if page.aside[e] or page.main[e] < wanted:
            beside += 1
            continue
        content = nodes.get(key, 1.0)
        importance = (1 - FROM_BRANCH) * content + FROM_BRANCH * composite[e]
        if importance < (NOISE_IN_MAIN if page.main[e] == REAL_MAIN else NOISE):
            noise += 1
        else:
            kept.append(text)
    return "\n".join(kept), len(kept), beside, noise


def extract(pages: DataFrame) -> DataFrame:
    """pages without html, with RESULTS; columns of pages with one of those names are replaced.

    text: the article's blocks, white space within a block as one space, joined by line feeds. n_blocks: the blocks in it;
    n_beside: blocks beside it by their elements and names; n_noise: blocks that the host's tree tells as noise. Pages
    without html are empty; those without a host, or of hosts with few pages, are judged by elements and names alone;
    rows that repeat a page are each returned.
    """
    stash = Stash(pages.sparkSession, "style_tree")
    results = _parse_datatype_string(RESULTS)
    others = [c for c in pages.columns if c not in (*results.names, "html")]
    packed = pages.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("row"), host(F.col("url")).alias("host"), "html")
    held = packed.join(trees(pages.select("url", "html"), stash), "host", "left").select("row", "html", F.map_keys("nodes").alias("keys"), F.map_values("nodes").alias("values"))

    def texts(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {name: [] for name in results.names}
        last: tuple = (None, None, {})
        for k, html in enumerate(batch["html"].to_pylist()):
            keys, values = batch["keys"][k], batch["values"][k]
            if not (keys.equals(last[0]) and values.equals(last[1])) if last[0] is not None else True:
                last = keys, values, dict(zip(keys.as_py() or [], values.as_py() or [], strict=True))
            text, *numbers = main_text(html or "", last[2])
            for name, value in zip(out, (text, len(text), *numbers), strict=True):
                out[name].append(value)
        return {"row": batch["row"], **out}

    made = map_rows(held, texts, StructType([held.schema["row"], *results.fields]))
    return made.select(*[F.col("row").getField(c).alias(c) for c in others], *results.names)
