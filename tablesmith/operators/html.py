"""Tables of encyclopedia pages: division tables, overview tables, infoboxes and pre-formatted blocks as rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import _parse_datatype_string

from tablesmith.functions.dom import Node, parse
from tablesmith.functions.league import HEADERS, REPRIEVED_TABLE
from tablesmith.operators.legends import CODES, ONE_CODE, PROMOTED, RELEGATED

#: Ids of sections and words of headings.
DIVISION_IDS = {
    "first": ("First_Division", "Football_League_First_Division", "First_Division_table"),
    "second": ("Second_Division", "Football_League_Second_Division", "Second_Division_table"),
}
ANY_DIVISION_IDS = ("Final_league_table", "League_table")
SECTION_IDS = (
    "League_tables", "League_table", "League_season", "League_season_(Men's)", "League_competitions", "League_competitions_(Men's)",
    "League_Competitions", "League_Competitions_(Men's)", "Final_standings", "Final_Standings", "Men's_football", "Mens_football",
)
SECTION_SCORES = (("league table", 100), ("league season", 90), ("league competitions", 80), ("men's football", 75), ("final standings", 95))
LEAGUE_WORDS = ("league", "division", "championship", "premier", "conference", "alliance", "combination", "section", "group")
PLAIN_HEADINGS = ("league table", "league tables", "final table", "final tables", "table", "tables", "league standings", "standings")
INFOBOX_TITLE = "The Football League"

_FIELD_OF = {name: field for field, names in HEADERS.items() for name in names}
_NUMBERS = ("pos", "played", "won", "drawn", "lost", "goalsFor", "goalsAgainst", "goalDifference", "goalAverage", "points")
_COLUMNS = ("pos", "played", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "goal_average", "points")
ROW = (
    "row_ord int, pos double, team string, played double, won double, drawn double, lost double, goals_for double, goals_against double, goal_difference double, goal_average double, "
    "points double, notes string, was_relegated boolean, was_promoted boolean, is_expansion_team boolean, was_re_elected boolean, was_reprieved boolean"
)
OVERVIEW_TABLE = "table_no int, title string, heading_id string, table_index int, is_top_flight boolean"
INFOBOX = "season string, relegated array<string>, new_clubs array<string>, folded array<string>, resigned array<string>"


def _clutter(n: Node) -> bool:
    return n.tag in ("style", "script") or n.tag in ("sup", "span") and "reference" in n.classes or any(c in n.classes for c in ("navbar", "plainlinks", "hlist"))


def cell_text(cell: Node) -> str:
    return re.sub(r"\[\d+\]", "", cell.text(_clutter)).strip()


def header_field(label: str) -> str:
    text = re.sub(r"\s+", " ", label.strip().lower()).replace(".", "")
    return "notes" if "qualification" in text or "relegation" in text else _FIELD_OF.get(text, text)


def _number(text: str | None, unicode_minus: bool) -> float | None:
    kept = re.sub(r"[^\d.-]", "", re.sub("[−–—]", "-", text or "") if unicode_minus else text or "")
    m = re.match(r"-?(\d+\.?\d*|\.\d+)", kept)
    return float(m[0]) if m else None


def _said(pattern: str, notes: str | None) -> bool:
    return bool(re.search(pattern, (notes or "").lower()))


class Dialect:
    """How a kind of page marks tables: titles in th alone or in td too, dashes as minus, and codes in team cells."""

    def __init__(self, title_cells: tuple[str, ...], unicode_minus: bool, several_codes: bool):
        self.title_cells, self.unicode_minus, self.several_codes = title_cells, unicode_minus, several_codes

    def codes(self, text: str) -> list[str]:
        return [c for part in re.split(r"[,/]|\band\b|\bor\b", text, flags=re.I) if (c := re.sub("[^A-Za-z0-9+]", "", part).upper())]

    def legend(self, table: Node) -> dict[str, set[str]]:
        """What codes stand for, from the notes after a table, before another table or heading."""
        for n in table.following():
            if re.search("sports-table-notes|legend", n.attributes.get("class", ""), re.I if self.several_codes else 0):
                text = re.sub(r"\s+", " ", n.text(lambda x: "reference" in x.classes or x.tag in ("style", "script")))
                found: dict[str, set[str]] = {}
                for m in re.finditer(CODES if self.several_codes else ONE_CODE, text):
                    for code in self.codes(m[1]) if self.several_codes else [m[1].upper()]:
                        found.setdefault(code, set()).update(side for side, p in (("promoted", PROMOTED), ("relegated", RELEGATED)) if re.search(p, m[2].lower()))
                if found:
                    return found
            if n.tag == "table" or (re.fullmatch("h[1-6]", n.tag) if self.several_codes else heading_level(n)):
                break
        return {}

    def symbols(self, cell: Node) -> set[str]:
        out: set[str] = set()
        for k, text in enumerate([cell.text(), *(n.text() for n in cell.walk())]):
            if self.several_codes:
                for inner in re.findall(r"\(([^)]+)\)", text):
                    out.update(self.codes(inner))
                out.update(self.codes(text) if k else ())
            else:
                tokens = [t.strip() for inner in re.findall(r"\(([^()]+)\)", text) for t in re.split("[,/]", inner)]
                out.update(t.upper() for t in [*tokens, re.sub("[()]", "", text).strip()] if re.fullmatch("[A-Za-z0-9+]{1,3}", t))
        return out

    def rows(self, table: Node, promotes: bool, legend_promotes: bool) -> list[dict]:
        """Rows that have a place and a team. Notes that span rows are carried down."""
        lines = table.tags("tr")
        if not lines:
            return []
        fields = [header_field(cell_text(c)) for c in lines[0].tags(*self.title_cells)]
        notes_at = fields.index("notes") if "notes" in fields else len(fields) - 1
        legend, out, carried, left = self.legend(table), [], None, 0
        for line in lines[1:]:
            cells = line.find(lambda n: n.tag == "td" or n.tag == "th" and n.attributes.get("scope") == "row")
            if not cells:
                continue
            texts = [self._cell(c) for c in cells]
            if not any(re.match(r"\s*[+-]?\d", t) for t in texts) and any(re.search("team|club|pld|pts", t, re.I) for t in texts):
                continue
            values = {f: texts[i] for i, f in reversed(list(enumerate(fields))) if i < len(texts)}
            row = {c: _number(values.get(f), self.unicode_minus) for f, c in zip(_NUMBERS, _COLUMNS)}
            row["team"], notes = values.get("team") or None, None
            every = line.tags("td", "th")
            if 0 <= notes_at < len(every):
                notes = cell_text(every[notes_at]) or None
                span = re.match(r"\s*(\d+)", every[notes_at].attributes.get("rowspan") or "1")
                carried, left = (notes, int(span[1]) - 1) if span and int(span[1]) > 1 else (None, 0)
            elif notes_at >= 0 and left > 0:
                notes, left = carried, left - 1
            row |= {"notes": notes, "was_promoted": promotes and _said("promot", notes), "was_relegated": _said("relegat|demoted to the", notes), "was_re_elected": _said("re-elected", notes)}
            row |= {"is_expansion_team": _said("expansion|new club|admitted|joined league", notes), "was_reprieved": _said(REPRIEVED_TABLE, notes)}
            at = fields.index("team") if "team" in fields else len(cells)
            if legend and at < len(cells):
                meanings = set().union(*(legend.get(s, set()) for s in self.symbols(cells[at])))
                row["was_promoted"] |= legend_promotes and "promoted" in meanings
                row["was_relegated"] |= "relegated" in meanings
            if row["team"] and row["pos"] is not None:
                out.append(row | {"row_ord": len(out)})
        return out

    def _cell(self, cell: Node) -> str:
        link = cell.first(lambda n: n.tag == "a") if cell.tag == "th" else None
        return (link.text().strip() if link else "") or cell_text(cell)


DIVISION = Dialect(("th",), False, True)
OVERVIEW = Dialect(("th", "td"), True, False)


def parse_division(html: str | None, division: str) -> list[dict]:
    """Rows of the first or second division's table: the first wikitable after its heading's block."""
    root = parse(html)
    by_id = lambda names: next((n for name in names if (n := root.first(lambda x: x.attributes.get("id") == name))), None)
    head = by_id(DIVISION_IDS.get(division, ()))
    wanted = "second division" if division == "second" else "first division"
    head = head or root.first(lambda n: n.tag == "span" and "mw-headline" in n.classes and wanted in n.text().strip().lower()) or by_id(ANY_DIVISION_IDS)
    block = head.closest(lambda n: n.tag == "div") if head else None
    table = next((n for n in block.following() if "wikitable" in n.classes), None) if block else None
    promotes = "first" not in division.lower()
    return DIVISION.rows(table, promotes, promotes) if table else []


def heading_level(n: Node) -> int | None:
    m = re.search(r"mw-heading(\d)", n.attributes.get("class", ""))
    return int(m[1]) if m and int(m[1]) else None


def is_top_flight(title: str | None, premier_league: bool) -> bool:
    text = (title or "").lower()
    return "premier league" in text or "football league premier division" in text or "first division" in text and not premier_league


def _section_heading(root: Node) -> Node | None:
    heads = root.tags("h2")
    for name in SECTION_IDS:
        if found := next((h for h in heads if h.attributes.get("id") == name), None):
            return found
    best, best_score = None, 0
    for h in heads:
        text = h.text().strip().lower()
        score = next((s for start, s in SECTION_SCORES if text.startswith(start)), 70 if "league" in text and "table" in text else 0)
        if score:
            score += 5 * ("men" in text) - 5 * ("women" in text)
            if score > best_score:
                best, best_score = h, score
    return best


def _own_tables(wrapper: Node, level: int) -> Iterator[Node]:
    """Wikitables of a heading's own section; sections of deeper headings are left out."""
    deeper = False
    for n in wrapper.following():
        below = heading_level(n)
        if below:
            if below <= level:
                return
            deeper = True
        elif not deeper:
            if n.tag == "table" and "wikitable" in n.classes:
                yield n
            else:
                yield from n.find(lambda x: x.tag == "table" and "wikitable" in x.classes)


def _heading_tables(wrapper: Node, title: str | None, head_id: str | None, premier_league: bool) -> list[dict]:
    level = heading_level(wrapper)
    head = wrapper.first(lambda n: n.tag == f"h{level}") if level else None
    if head is None:
        return []
    own = head.text().strip()
    head_id = head.attributes.get("id") or head_id
    shown = title if title and (not own or own.lower() in PLAIN_HEADINGS) else own or title or head_id or "Unknown league"
    top = is_top_flight(shown, premier_league)
    tables = list(_own_tables(wrapper, level))
    found = [(k, OVERVIEW.rows(t, not top, True)) for k, t in enumerate(tables)]
    return [{"title": shown, "heading_id": head_id, "table_index": k, "is_top_flight": top, "rows": rows} for k, rows in found if rows]


def parse_overview(html: str | None) -> list[dict]:
    """Tables of a season's page: of the league section's headings, else of all headings in a league's context."""
    root = parse(html)
    premier_league = any("premier league" in n.text().lower() for n in root.tags("h2", "h3", "h4", "h5"))
    section, out = _section_heading(root), []
    if section is not None:
        start = section.closest(lambda n: "mw-heading" in n.classes) or section
        for n in start.following():
            level = heading_level(n)
            if level == 2:
                break
            if level and 3 <= level <= 5:
                out += _heading_tables(n, None, None, premier_league)
        return out
    open_: list[tuple[int, str | None, str | None, bool]] = []
    for n in root.find(lambda x: "mw-heading" in x.classes):
        level = heading_level(n)
        if not level or not 2 <= level <= 5:
            continue
        open_ = [h for h in open_ if h[0] < level]
        head = n.first(lambda x: x.tag == f"h{level}")
        if head is None:
            open_.append((level, None, None, False))
            continue
        title = head.text().strip()
        league = any(w in title.lower() for w in LEAGUE_WORDS) or any(h[3] for h in open_)
        above = next((h for h in reversed(open_) if h[3] and h[1]), None) if title.lower() in PLAIN_HEADINGS else None
        open_.append((level, title, head.attributes.get("id"), league))
        if league:
            out += _heading_tables(n, above and above[1], above and above[2], premier_league)
    return out


def parse_infobox(html: str | None) -> dict:
    """Facts of the league's infobox: the season, and linked names of relegated, new, folded and resigned clubs."""
    fields = {"relegated": ("Relegated",), "new_clubs": ("New Club in League", "New Clubs in League"), "folded": ("Folded",), "resigned": ("Resigned",)}

    def titled(n: Node) -> bool:
        captions = n.find(lambda c: c.tag == "caption" and "infobox-title" in c.classes)
        links = [a for c in captions for a in c.tags("a")]
        return n.tag == "table" and "infobox" in n.classes and bool(links) and "".join(a.text() for a in links).strip() == INFOBOX_TITLE

    def cells(box: Node, names: tuple[str, ...]) -> list[Node]:
        heads = box.find(lambda n: n.tag == "th" and any(name in n.text() for name in names))
        return [c for h in heads if (c := h.next()) is not None and c.tag == "td"]

    box = parse(html).first(titled)
    if box is None:
        return {"season": "", **{f: [] for f in fields}}
    out: dict = {"season": "".join(c.text() for c in cells(box, ("Season",))).strip()}
    for field, names in fields.items():
        own = cells(box, names)
        none = "".join(c.text() for c in own).strip().lower() == "none"
        out[field] = [] if none else [a.text().strip() for c in own for a in c.tags("a")]
    return out


def parse_blocks(html: str | None) -> list[str]:
    return [n.text() for n in parse(html).tags("pre")]


def _table(pages: DataFrame, keys: list[str], schema: str, make) -> DataFrame:
    """Rows that make(html) gives for each page, after its key columns."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in keys]
    whole = ", ".join([*kept, schema])
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(_parse_datatype_string(whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made = make(row.pop("html"))
                if made:
                    yield pa.RecordBatch.from_pylist([{k: row[k] for k in keys} | m for m in made], schema=target)

    return pages.select(*keys, "html").mapInArrow(run, whole)


def division_rows(pages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., division, row_ord, fields) of pages(keys..., html): both divisions of each page."""
    return _table(pages, keys, "division string, " + ROW, lambda html: [{"division": d} | r for d in DIVISION_IDS for r in parse_division(html, d)])


def overview_rows(pages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., table_no, title, heading_id, table_index, is_top_flight, row_ord, fields) of pages(keys..., html)."""
    def make(html: str | None) -> list[dict]:
        return [{"table_no": k, **{c: t[c] for c in ("title", "heading_id", "table_index", "is_top_flight")}} | r for k, t in enumerate(parse_overview(html)) for r in t["rows"]]

    return _table(pages, keys, f"{OVERVIEW_TABLE}, {ROW}", make)


def infoboxes(pages: DataFrame, keys: list[str]) -> DataFrame:
    return _table(pages, keys, INFOBOX, lambda html: [parse_infobox(html)])


def text_blocks(pages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., block_no, text) of the pre-formatted blocks."""
    return _table(pages, keys, "block_no int, text string", lambda html: [{"block_no": k, "text": t} for k, t in enumerate(parse_blocks(html))])
