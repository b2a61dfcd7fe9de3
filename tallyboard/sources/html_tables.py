"""First HTML table of each page, as rows of text cells.

Tag soup is the one input Spark has no built-in reader for. Pages go through a
small Python tokenizer in Arrow batches; choosing, typing and naming of columns
happens in Spark again.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from tallyboard import schemas as S
from tallyboard.functions import rank_text, season_label

# The parser travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NAME = re.compile(r"<(/?)([a-z][^\s/>]*)", re.I)
# To the tag's end. A quote counts after an equals sign alone, and none of the repeats gives back
# what it has taken, so a tag is read once.
_REST = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
# Elements whose content holds no markup, and those of them whose content is not shown.
_RAW = {n: re.compile(rf"</{n}(?=[\s/>])", re.I)
        for n in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
_UNSHOWN = {"script", "style", "iframe", "noembed", "noframes"}
_SPAN = re.compile(r"\b(colspan|rowspan)\s*=\s*[\"']?(\d+)", re.I)
_HIDDEN = re.compile(r"style\s*=\s*(?:\"[^\"]*|'[^']*)display\s*:\s*none", re.I)
_MAX_SPAN = 100_000  # a table with a wider cell is not read, rather than being cut
_BREAKS = {"br", "p", "div", "li"}


class _Cell:
    def __init__(self, header: bool, attributes: str):
        spans = {k.lower(): int(v) for k, v in _SPAN.findall(attributes)} if attributes else {}
        self.header = header
        self.across = max(spans.get("colspan", 1), 1)
        if self.across > _MAX_SPAN:
            raise ValueError(f"a table cell spans {self.across} columns")
        self.down = max(spans.get("rowspan", 1), 1)
        self.parts: list[str] = []

    def text(self) -> str:
        text = "".join(self.parts)
        return " ".join((entities.unescape(text) if "&" in text else text).split())


def _markup(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, closing, tag, attributes) of every tag; comments and unshown content as a tag without name.

    One pass forward. What a comment, a tag or an unshown element leaves open runs to the
    page's end, as it does in a browser.
    """
    at = page.find("<")
    while at >= 0:
        if page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            end = len(page) if close < 0 else close + 3
            yield at, end, False, "", ""
        elif name := _NAME.match(page, at):
            rest = _REST.match(page, name.end())
            if not rest:
                yield at, len(page), False, "", ""
                return
            closing, tag, end = name[1] == "/", name[2].lower(), rest.end()
            close = _RAW[tag].search(page, end) if tag in _RAW and not closing else None
            if tag in _UNSHOWN and not closing:
                end = close.start() if close else len(page)
                yield at, end, False, "", ""
            else:
                yield at, end, closing, tag, rest[1]
                if tag in _RAW and not closing:
                    end = close.start() if close else len(page)
        else:
            end = at + 1
        at = page.find("<", end)


def _rows_of_first_table(page: str) -> list[tuple[bool, list[_Cell]]] | None:
    """Rows (in a head section?, cells) of the first shown table; None when there is no table.

    End tags of cells and rows may be missing. A table inside a cell counts as
    that cell's text. Tables, rows and cells styled away are left out.
    """
    rows: list[tuple[bool, list[_Cell]]] | None = None
    depth, at = 0, 0
    in_head = hidden_table = hidden_row = False
    cell: _Cell | None = None
    for start, end, closing, tag, attributes in _markup(page):
        if cell is not None:
            cell.parts.append(page[at:start])
        at = end
        if tag == "table" and not closing:
            if depth == 0:
                rows, cell, hidden_table = [], None, _HIDDEN.search(attributes) is not None
            depth += 1
        elif tag == "table" and depth:
            depth -= 1
            if depth == 0 and not hidden_table:
                return rows
            rows = None if depth == 0 else rows
        elif depth == 1 and tag in ("thead", "tbody", "tfoot"):
            in_head, cell = tag == "thead" and not closing, None
        elif depth == 1 and tag == "tr":
            cell = None
            if not closing:
                hidden_row = _HIDDEN.search(attributes) is not None
                rows.append((in_head, []))
        elif depth == 1 and tag in ("td", "th"):
            cell = None
            if not closing and not hidden_row and not _HIDDEN.search(attributes):
                if not rows:
                    rows.append((in_head, []))
                cell = _Cell(tag == "th", attributes)
                rows[-1][1].append(cell)
        elif cell is not None and tag in _BREAKS:
            cell.parts.append(" ")
    return None if hidden_table else rows


def parse_first_table(page: str) -> tuple[list[str], list[list[str]]] | None:
    """Last header row and the body rows of the first table, spans filled in."""
    found = _rows_of_first_table(page)
    if found is None:
        return None
    found = [r for r in found if r[1]]
    if not any(in_head for in_head, _ in found):
        leading = True
        for i, (_, cells) in enumerate(found):
            leading = leading and all(c.header for c in cells)
            found[i] = (leading, cells)
    header: list[str] = []
    body: list[list[str]] = []
    carried: dict[int, tuple[int, str]] = {}  # column -> (rows left, text) of a rowspan
    for in_head, cells in found:
        line: list[str] = []
        queue = deque(cells)
        while queue or len(line) in carried:
            if len(line) in carried:
                left, text = carried.pop(len(line))
                if left > 1:
                    carried[len(line)] = (left - 1, text)
                line.append(text)
                continue
            cell = queue.popleft()
            text = cell.text()
            for _ in range(cell.across):
                if cell.down > 1:
                    carried[len(line)] = (cell.down - 1, text)
                line.append(text)
        if in_head:
            header = line
        else:
            body.append(line)
    return header, body


def first_tables(pages: DataFrame, keys: Sequence[str], columns: Sequence[str], html: str = "html",
                 on_missing: str = "raise") -> DataFrame:
    """Rows of each page's first table: keys, ``row_no``, and the named columns as text.

    Names are looked up in the last header row; a row that is too short gives
    null. A page without a table, without a named column, or whose table cannot
    be laid out raises, or is left out with ``on_missing="skip"``; then pages
    without a table tag never reach Python.
    """
    skip = on_missing == "skip"
    if skip:
        pages = pages.where(F.lower(html).contains("<table"))
    schema = T.StructType([*[pages.schema[k] for k in keys], T.StructField("row_no", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in columns]])
    width, names = len(keys), schema.names
    arrow_types = [pa.int64(), *[pa.string()] * len(columns)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_at: list[int] = []
            out: list[list] = [[] for _ in arrow_types]
            for page_no, page in enumerate(batch.column(width).to_pylist()):
                try:
                    table, why = parse_first_table(page or ""), f"no table with {list(columns)}"
                except ValueError as e:
                    table, why = None, str(e)
                if table is None or not set(columns) <= set(table[0]):
                    if skip:
                        continue
                    raise ValueError(f"{why} in page {[batch.column(k)[page_no].as_py() for k in range(width)]}")
                at = [table[0].index(c) for c in columns]
                for row_no, cells in enumerate(table[1]):
                    pages_at.append(page_no)
                    out[0].append(row_no)
                    for values, i in zip(out[1:], at):
                        values.append(cells[i] if i < len(cells) else None)
            taken = pa.array(pages_at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(taken) for k in range(width)]
                + [pa.array(v, t) for v, t in zip(out, arrow_types)], names)

    return pages.select(*keys, F.col(html)).mapInArrow(extract, schema)


def award_rows(pages: DataFrame, url: str = "url", html: str = "html",
               on_missing: str = "raise", keys: Sequence[str] = ()) -> DataFrame:
    """Rank, player, share and season label of every vote row; the season is the year in the URL."""
    year = F.regexp_extract(F.col(url), S.AWARD_URL_YEAR, 1)
    dated = pages.withColumn("__year", F.when(year != "", year.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("no season in url "), F.col(url)))))
    rows = first_tables(dated, ["__year", *keys], ["Rank", "Player", "Share"], html, on_missing)
    return rows.select(
        *keys, rank_text(F.col("Rank")).alias("Rank"), "Player",
        # Thousands separators are dropped.
        F.nullif(F.trim(F.translate("Share", ",", "")), F.lit("")).cast("double").alias("Share"),
        season_label(F.col("__year")).alias("award_season"))
