"""Publishing: JSON datasets, CSV by tier and chunk, raw pages, reports and exit codes."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesmith.functions.js import js_parse_int, key_order
from tablesmith.operators.dataset import Dataset, tier_json
from tablesmith.operators.lint import issue_order
from tablesmith.sources.json_ranges import stripped
from tablesmith.sources.publish import publish

#: Rows of a CSV file at most.
ROWS_A_FILE = 1_000_000


def seasons_json(data: Dataset) -> DataFrame:
    """(season_key, json): a row for each season, its blocks in order."""
    blocks = F.transform(F.array_sort(F.collect_list(F.struct("tier_ord", "tier_key", "json"))), lambda b: F.concat(F.lit('"'), b["tier_key"], F.lit('":'), b["json"]))
    held = tier_json(data).groupBy("season_key").agg(F.min("season_ord").alias("place"), F.concat(F.lit("{"), F.array_join(blocks, ","), F.lit("}")).alias("json"))
    return held.orderBy(*key_order(F.col("season_key"), F.col("place"))).select("season_key", "json")


def save_json(data: Dataset, path: str, pretty: bool | int = True) -> None:
    """One file {"seasons": {...}}: two spaces, a number of spaces, or compact; on any file system that Spark knows.

    Seasons are put in order by ranges and written by as many tasks; see publish(). A season is an object, so each ends
    with the brace that ends a line of a fragment.
    """
    spaces = 2 if pretty is True else pretty or 0
    line, pad, colon = ("\n", " " * spaces, ": ") if spaces else ("", "", ":")
    places = data.tiers.groupBy("season_key").agg(F.min("season_ord").alias("place"))
    first = places.orderBy(*key_order(F.col("season_key"), F.col("place"))).select("season_key").first()

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, held in zip(batch["season_key"].to_pylist(), batch["json"].to_pylist(), strict=True):
                season = json.dumps(json.loads(held), ensure_ascii=False, indent=spaces or None, separators=None if spaces else (",", ":"))
                whole = season.replace(line, line + pad * 2) if spaces else season
                out.append(f"{'' if key == first[0] else ','}{line}{pad * 2}{json.dumps(key, ensure_ascii=False)}{colon}{whole[:-1]}")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    head = f"{{{line}{pad}{json.dumps('seasons')}{colon}{{"
    publish(seasons_json(data).mapInArrow(lines, "value string"), path, "}", head, f"{line + pad if first else ''}}}{line}}}")


def write_json(path: str, value: object, pretty: bool | int = True) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    spaces = 2 if pretty is True else pretty if pretty else None
    with open(path, "w", encoding="utf-8") as out:
        json.dump(value, out, ensure_ascii=False, indent=spaces, separators=None if spaces else (",", ":"))


def minified_name(path: str, in_place: bool = False, suffix: str = ".min") -> str:
    base, ext = os.path.splitext(path)
    return path if in_place else f"{base}{suffix or '.min'}{ext or '.json'}"


def minify(spark: SparkSession, path: str, in_place: bool = False, suffix: str = ".min") -> str:
    """Rewrite a JSON object's file compactly, in place or beside it; order, numbers and texts stay as they are written. Returns the written path.

    White space outside strings is left out, in ranges of the file. A file that is no whole object is an error.
    """
    target = minified_name(path, in_place, suffix)
    publish(stripped(spark, path), target, "}")
    return target


def _save_csv(rows: DataFrame, path: str, parts: list[str], order: tuple[str, ...], rows_a_file: int) -> None:
    """CSV with a header in folders of parts. With an order, the files of a folder, by name, hold its rows in that order, and the order's columns are not written.

    Rows are dealt to tasks by ranges of parts and order, so that a folder of any size is spread over tasks and each task
    writes few folders; a file ends at rows_a_file rows.
    """
    by = [*parts, *order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop(*order) if order else rows
    placed.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).partitionBy(*parts).option("header", True).csv(path)


def save_by_tier(rows: DataFrame, path: str, order: tuple[str, ...] = (), rows_a_file: int = ROWS_A_FILE) -> None:
    """CSV with a header, one folder for each tier. Rows of one tier are spread over tasks, so that none writes a whole tier."""
    _save_csv(rows, path, ["tier"], order, rows_a_file)


def with_chunks(rows: DataFrame, size: int = 25, season: str = "Season") -> DataFrame:
    """rows with `chunk`, in the place of any column of that name: the first and last of each `size` seasons that a tier has, as text.

    Ranks come from the few different seasons. Rows whose season is no number, or whose tier is null, fall away; other columns stay.
    """
    number = js_parse_int(F.col(season))
    seasons = rows.select("tier", number.alias("__n")).filter("__n is not null").distinct()
    placed = seasons.withColumn("__c", F.floor((F.dense_rank().over(Window.partitionBy("tier").orderBy("__n")) - 1) / size))
    part = Window.partitionBy("tier", "__c")
    labelled = placed.select("tier", "__n", F.concat_ws("-", F.min("__n").over(part).cast("string"), F.max("__n").over(part).cast("string")).alias("chunk"))
    return rows.drop("chunk").withColumn("__n", number).join(labelled, ["tier", "__n"]).drop("__n")


def save_chunks(rows: DataFrame, path: str, size: int = 25, order: tuple[str, ...] = (), rows_a_file: int = ROWS_A_FILE) -> None:
    """CSV with a header, one folder for each tier and chunk of seasons."""
    _save_csv(with_chunks(rows, size), path, ["tier", "chunk"], order, rows_a_file)


def save_pages(pages: DataFrame, path: str) -> None:
    """Raw HTML of pages(slug, html), a folder for each slug."""
    pages.select("slug", "html").filter("html is not null").write.mode("overwrite").partitionBy("slug").text(path)


def told_issues(issues: DataFrame) -> Iterator[str]:
    """A line for each issue, in order, fetched a partition at a time."""
    for r in issues.orderBy(*issue_order()).toLocalIterator():
        yield f"[{r['rule']}] {r['season_key']}{' ' + r['tier_key'] if r['tier_key'] else ''}: {r['message']}"


def issue_lines(issues: DataFrame) -> list[str]:
    """All lines of few issues."""
    return list(told_issues(issues))


def exit_code(issues: DataFrame, fail: bool = True) -> int:
    """1 if there are issues and these are to fail; of overview issues only errors count."""
    rows = issues.filter("severity = 'error'") if "severity" in issues.columns else issues
    return int(fail and not rows.isEmpty())


def notes(data: Dataset) -> DataFrame:
    """(season_key, tier_key, team, notes) of rows with notes in tiers that are bare tables."""
    bare = data.tiers.filter("tier_kind = 'array'").select("source_rank", "season_key", "tier_key")
    return data.entries.filter("notes is not null").join(bare, bare.columns, "left_semi").select("season_key", "tier_key", "team", "notes")
