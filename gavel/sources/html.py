"""Pages as tables: lines, links, agenda rows, list rows, grid rows.

Links and lines are native expressions.  Table structure needs a parser; it runs
in Arrow batches over the `pages` rows and emits one row per table row, after
which everything is DataFrame work again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.base import ColumnLike, col, lines_of, squash, strip
from ..functions.dates import date_in_text, parse_date
from ..functions.text import agenda_type, file_number, is_addendum
from ..functions.urls import absolute_url, direct_download

# The entities that are decoded (the ampersand last).
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def decode(text: ColumnLike) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, col(text))


def visible_text(html: ColumnLike) -> Column:
    """Text of a page, one line per block, scripts, styles and comments left out."""
    t = F.regexp_replace(col(html), r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "")
    t = F.regexp_replace(t, r"(?i)<(?:/?(?:p|div|li|ul|ol|tr|td|th|table|h[1-6]|article|nav|section|title|body|head|html)\b[^>]*|br\b[^>]*)>", "\n")
    return decode(F.regexp_replace(t, r"<[^>]*>", ""))


def page_lines(html: ColumnLike) -> Column:
    return lines_of(visible_text(html))


def headings(html: ColumnLike) -> Column:
    inner = F.regexp_extract_all(col(html), F.lit(r"(?is)<h1\b[^>]*>(.*?)</h1\s*>"), F.lit(1))
    return F.transform(inner, lambda h: strip(decode(F.regexp_replace(h, r"<[^>]*>", ""))))


def page_title(html: ColumnLike) -> Column:
    return squash(decode(F.regexp_extract(col(html), r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)))


def anchors(html: ColumnLike) -> Column:
    """Array of struct(href, title, text) of every link with an href."""
    tags = F.regexp_extract_all(col(html), F.lit(r"(?is)<a\b[^>]*\bhref\s*=\s*[^>]*>.*?</a\s*>"), F.lit(0))

    def attr(tag, name):
        return decode(F.regexp_extract(tag, rf"""(?is)^<a\b[^>]*?\b{name}\s*=\s*["']([^"']*)["']""", 1))

    return F.transform(
        tags,
        lambda a: F.struct(
            attr(a, "href").alias("href"),
            strip(attr(a, "title")).alias("title"),
            strip(decode(F.regexp_replace(a, r"<[^>]*>", ""))).alias("text"),
        ),
    )


def links(pages: DataFrame, contains: str, keep: list[str]) -> DataFrame:
    """One row per link whose href contains a text, in page order."""
    found = F.filter(anchors("html"), lambda a: a["href"].contains(contains))
    return pages.select(*keep, F.posexplode(found).alias("pos", "a")).select(*keep, "pos", "a.*")


def supporting_documents(pages: DataFrame, keep: list[str], base: str) -> DataFrame:
    """Document links of an item page as document rows (default title chain applied)."""
    found = links(pages, "DownloadFile", keep)
    url = absolute_url(direct_download("href"), base)
    title = F.coalesce(F.nullif("text", F.lit("")), F.nullif("title", F.lit("")), F.lit("Document"))
    return found.select(
        *keep,
        F.col("pos").alias("doc_pos"),
        title.alias("title"),
        url.alias("url"),
        F.col("title").alias("originalTitle"),
        F.col("text").alias("originalText"),
    )


def page_facts(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Date, agenda type and addendum flag of each page."""
    h1 = headings("html")
    marked = F.filter(h1, lambda h: F.upper(F.regexp_replace(h, r"\s+", "")).rlike("FINAL|DRAFT"))
    title_date = F.regexp_extract(page_title("html"), r"(\d{1,2}/\d{1,2}/\d{4}|\d{4}-\d{2}-\d{2}|[A-Za-z]+ \d{1,2}, \d{4})", 1)
    labelled = F.regexp_extract("html", r"""(?is)<\w+\b[^>]*\b(?:id|class)\s*=\s*["'][^"']*date[^"']*["'][^>]*>([^<]{6,})<""", 1)
    return pages.select(
        *keep,
        page_title("html").alias("title"),
        F.coalesce(parse_date(strip(labelled)), parse_date(title_date), date_in_text(visible_text("html"))).alias("date"),
        agenda_type(F.try_element_at(marked, F.lit(1))).alias("agenda_type"),
        is_addendum(visible_text("html")).alias("is_addendum"),
    )


def heading_meeting_type(html: ColumnLike, fixed_heading: str) -> Column:
    """Text of the heading that follows a fixed one."""
    h1 = F.transform(headings(html), lambda h: F.regexp_replace(h, r"\s+", " "))
    return F.get(h1, F.array_position(h1, fixed_heading).cast("int"))


# --- table rows --------------------------------------------------------------

ROWS_DDL = (
    "table_no int, row_no int, row_id string, cells array<string>, "
    "links array<struct<cell int, href string, id string, text string>>"
)


class _Tables(HTMLParser):
    """Collects table rows with the texts and links of their data cells.

    Open tables form a stack, so a table inside a cell leaves the outer row open; its text and links belong to the
    outer cell too.  A row or cell ends with its end tag, with the next one of its kind, or with its table.  Rows
    are numbered outside `thead` and `tfoot` only; those get -1."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.tables = 0
        self.open: list[dict] = []
        self.link: dict | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            self.open.append({"no": self.tables, "next": 0, "body": True, "row": None, "in_cell": False})
            self.tables += 1
        elif not self.open:
            return
        elif tag in ("thead", "tfoot", "tbody"):
            self._end_row()
            self.open[-1]["body"] = tag == "tbody"
        elif tag == "tr":
            self._end_row()
            t = self.open[-1]
            t["row"] = {"r": t["next"] if t["body"] else -1, "id": a.get("data-meeting-id"), "cells": [], "links": []}
            t["next"] += t["body"]
        elif tag in ("td", "th") and self.open[-1]["row"] is not None:
            self._end_link()
            self.open[-1]["in_cell"] = tag == "td"
            if tag == "td":
                self.open[-1]["row"]["cells"].append("")
        elif tag == "a" and any(t["in_cell"] for t in self.open):
            self._end_link()
            self.link = {"href": a.get("href") or "", "id": a.get("id"), "text": ""}

    def handle_data(self, data):
        for t in self.open:
            if t["in_cell"]:
                t["row"]["cells"][-1] += data
        if self.link is not None:
            self.link["text"] += data

    def handle_endtag(self, tag):
        if tag == "a":
            self._end_link()
        elif not self.open:
            return
        elif tag in ("td", "th"):
            self._end_link()
            self.open[-1]["in_cell"] = False
        elif tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_row()
            if tag in ("thead", "tfoot"):
                self.open[-1]["body"] = True
        elif tag == "table":
            self._end_row()
            self.open.pop()

    def close(self) -> None:
        super().close()
        while self.open:
            self.handle_endtag("table")

    def _end_link(self) -> None:
        if self.link is not None:
            for t in self.open:
                if t["in_cell"]:
                    cell = len(t["row"]["cells"]) - 1
                    t["row"]["links"].append({"cell": cell, **self.link, "text": self.link["text"].strip()})
            self.link = None

    def _end_row(self) -> None:
        self._end_link()
        t = self.open[-1]
        r, t["row"], t["in_cell"] = t["row"], None, False
        if r is not None:
            self.rows.append((t["no"], r["r"], r["id"], [c.strip() for c in r["cells"]], r["links"]))


# Plain markup: tags with quoted attributes, short comments and a doctype.  The parser reads it alike, only slower.
_TAG = re.compile(
    r"""</([a-zA-Z][a-zA-Z0-9]*)>|<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z_][-a-zA-Z0-9_]*(?:="[^"<>]*"|='[^'<>]*')?)*)[ \t\n]*(/?)>"""
    r"""|<!--[^-<>]+-->|<!(?i:doctype)[ ][^<>"']*>"""
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_][-a-zA-Z0-9_]*)(?:(=)(?:"([^"]*)"|'([^']*)'))?""")
_ODD_REFERENCE = re.compile(r"&(?!(?:amp|lt|gt|quot|nbsp|#39);)")
_SHAPING = frozenset(("table", "thead", "tbody", "tfoot", "tr", "td", "th", "a"))
_RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "plaintext", "xmp"))


_PIECE = re.compile("(<[^<>]*>)")


def _plain_tag(text: str) -> tuple[str, list, bool, bool] | None:
    """Name, attributes, is it an end tag, is it closed at once; no name where it shapes no table, None if it is not plain."""
    m = _TAG.fullmatch(text)
    if m is None:
        return None
    end, tag, attributes, closed = m.groups()
    name = (end or tag or "").lower()
    if name in _RAW or (attributes and "&" in attributes and _ODD_REFERENCE.search(attributes)):
        return None
    if name not in _SHAPING:
        return "", [], False, False
    pairs = [(a.lower(), unescape(double or single) if given else None) for a, given, double, single in _ATTRIBUTE.findall(attributes or "")]
    return name, pairs, bool(end), bool(closed)


_SHORT_TAGS: dict[str, tuple | None] = {}  # what the shortest tags are; there are few of them


def _read_plain(html: str, parser: _Tables) -> bool:
    """Give plain markup to the parser's handlers; False if the page holds anything else."""
    is_tag = True
    for piece in _PIECE.split(html):
        is_tag = not is_tag
        if not is_tag:
            if piece:
                if "<" in piece:
                    return False
                if parser.open or parser.link is not None:
                    parser.handle_data(unescape(piece) if "&" in piece else piece)
            continue
        found = _SHORT_TAGS.get(piece)
        if found is None:
            found = _plain_tag(piece)
            if found is None:
                return False
            if len(piece) <= 8 and len(_SHORT_TAGS) < 1000:
                _SHORT_TAGS[piece] = found
        name, pairs, ends, closed = found
        if ends:
            parser.handle_endtag(name)
        elif name:
            parser.handle_starttag(name, pairs)
            if closed:
                parser.handle_endtag(name)
    return True


def page_rows(html: str | None) -> list[tuple]:
    """The table rows of one page: table, row, id, cells and links."""
    parser = _Tables()
    if not _read_plain(html or "", parser):
        parser = _Tables()
        parser.feed(html or "")
    parser.close()
    return parser.rows


def table_rows(pages: DataFrame, key: str) -> DataFrame:
    """One row per HTML table row of every page; `cells` are its data cells, without headings."""
    link = pa.struct([("cell", pa.int32()), ("href", pa.string()), ("id", pa.string()), ("text", pa.string())])
    types = [pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(link)]
    names = ["table_no", "row_no", "row_id", "cells", "links"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_rows(html) for html in batch.column(1).to_pylist()]
            of = pa.array([i for i, rows in enumerate(found) for _ in rows], pa.int64())
            columns = list(zip(*(row for rows in found for row in rows))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), *map(pa.array, columns, types)], names=[key, *names])

    schema = T.StructType([pages.schema[key], *T.StructType.fromDDL(ROWS_DDL).fields])
    return pages.select(key, "html").mapInArrow(parse, schema)


def agenda_rows(pages: DataFrame, key: str) -> DataFrame:
    """Agenda items: first body row of a table, a numbered cell and a load link in the next one."""
    rows = table_rows(pages, key).where((F.col("row_no") == 0) & (F.size("cells") >= 2))
    load = F.filter("links", lambda a: (a["cell"] == 1) & a["href"].contains("loadAgendaItem"))
    content = F.get("cells", F.lit(1))
    return (
        rows.withColumn("link", F.try_element_at(load, F.lit(1)))
        .withColumn("number", F.regexp_extract(F.get("cells", F.lit(0)), r"^(\d+)\.", 1).try_cast("int"))
        .where(F.col("number").isNotNull() & F.col("link").isNotNull())
        .select(
            key,
            "number",
            F.nullif(F.regexp_extract("link.href", r"loadAgendaItem\((\d+)", 1), F.lit("")).alias("agenda_item_id"),
            content.alias("raw_text"),
            F.col("link.id").alias("link_id"),
            file_number(content).alias("file_number"),
        )
    )


def has_agenda_link(cells_links: ColumnLike) -> Column:
    """An agenda link that is not only a summary link."""

    def agenda(a):
        t = F.lower(a["text"])
        return ~t.contains("summary") & (t.contains("agenda") | a["href"].contains("doctype=1"))

    return F.exists(col(cells_links), agenda)


def meeting_list_rows(pages: DataFrame, key: str, base: str) -> DataFrame:
    """Rows of the first table that name a meeting and link its agenda in the last cell."""
    rows = table_rows(pages, key).where((F.col("table_no") == 0) & (F.coalesce(F.col("row_id"), F.lit("")) != ""))
    last = F.filter("links", lambda a: a["cell"] == F.size("cells") - 1)
    rows = rows.withColumn("last", last).where(has_agenda_link("last"))
    view = F.filter("last", lambda a: a["href"].contains("ViewMeeting") & a["href"].contains("doctype=1"))
    return rows.select(
        key,
        F.col("row_id").alias("id"),
        rules.by_keyword(F.array_join("cells", " "), rules.LIST_ROW_KEYWORDS).alias("type"),
        absolute_url(F.try_element_at(view, F.lit(1))["href"], base).alias("href"),
    )


def transcript_index_rows(pages: DataFrame, key: str) -> DataFrame:
    """Grid rows with three or more cells, a date and a transcript link."""
    rows = table_rows(pages, key).where(F.size("cells") >= 3)
    link = F.try_element_at(F.filter("links", lambda a: a["href"].contains("pkey=")), F.lit(1))
    date_cell = F.try_element_at(F.filter("cells", lambda c: c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$")), F.lit(1))
    title = F.try_element_at(
        F.filter("cells", lambda c: (F.length(c) > 0) & ~c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$")), F.lit(1)
    )
    return (
        rows.select(
            key,
            F.nullif(F.regexp_extract(link["href"], r"pkey=(\d+)", 1), F.lit("")).alias("pkey"),
            parse_date(date_cell).alias("date"),
            title.alias("title"),
        )
        .where(F.col("pkey").isNotNull() & F.col("date").isNotNull())
        .withColumn("meeting_type", rules.by_keyword("title"))
    )


def item_details(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Title block, background block and whole text of an item page."""
    body = visible_text("html")
    title = F.regexp_extract("html", r"""(?is)class\s*=\s*["'][^"']*item-view-title-text[^"']*["'][^>]*>(.*?)</""", 1)
    background = F.regexp_extract(body, r"(?is)\bBackground\b\s*:?\s*(.*?)(?=\n\s*Fiscal|\z)", 1)
    return pages.select(
        *keep,
        strip(decode(F.regexp_replace(title, r"<[^>]*>", ""))).alias("title"),
        strip(background).alias("background"),
        strip(body).alias("body"),
    )
