"""Page parsers as table functions for SQL: select ... from pages, lateral parse_division(html)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tablesmith.operators.html import DIVISION_IDS, INFOBOX, OVERVIEW_TABLE, ROW, parse_blocks, parse_division, parse_infobox, parse_overview

_ROW = [f.strip().split()[0] for f in ROW.split(",")]
_LISTS = ("relegated", "new_clubs", "folded", "resigned")


class Division:
    """The rows of both divisions of a page; of none for null."""

    def eval(self, html: str) -> Iterator[tuple]:
        for division in DIVISION_IDS:
            for row in parse_division(html, division):
                yield (division, *(row[c] for c in _ROW))


class Overview:
    """The rows of all tables of a season's page."""

    def eval(self, html: str) -> Iterator[tuple]:
        for k, table in enumerate(parse_overview(html)):
            for row in table["rows"]:
                yield (k, *(table[c] for c in ("title", "heading_id", "table_index", "is_top_flight")), *(row[c] for c in _ROW))


class Infobox:
    """One row of facts a page, with empty lists where it has no box."""

    def eval(self, html: str) -> Iterator[tuple]:
        facts = parse_infobox(html)
        yield (facts["season"], *(facts[c] for c in _LISTS))


class Blocks:
    """The pre-formatted blocks of a page."""

    def eval(self, html: str) -> Iterator[tuple]:
        yield from enumerate(parse_blocks(html))


#: By their SQL names. Spark has no lateral joins with functions of whole Arrow batches; rows travel in Arrow batches all the same.
FUNCTIONS = {
    "parse_division": udtf(Division, returnType=f"division string, {ROW}", useArrow=True),
    "parse_overview": udtf(Overview, returnType=f"{OVERVIEW_TABLE}, {ROW}", useArrow=True),
    "parse_infobox": udtf(Infobox, returnType=INFOBOX, useArrow=True),
    "parse_blocks": udtf(Blocks, returnType="block_no int, text string", useArrow=True),
}


def register(spark: SparkSession) -> None:
    """Make FUNCTIONS known to a session's SQL."""
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, function)
