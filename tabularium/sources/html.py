"""Links, tables and indexes of HTML pages.

A page is read once into a flat list of marks (a tag opens, a tag closes, text); cells, rows and
links are folded from that list, so a cell keeps its text together with its links and a table may stand in another's cell.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import shipped, written

DOCUMENT_SUFFIXES = (".pdf", ".xlsx", ".xls", ".docx", ".doc", ".csv", ".ods", ".zip")
_BLOCKS = frozenset(("table", "tr", "td", "th"))


class Link(NamedTuple):
    """A link as it stands in a page."""

    href: str
    text: str


class Cell(NamedTuple):
    """A table cell: its text with single spaces, and its links."""

    text: str
    links: tuple[Link, ...]


class _Marks(HTMLParser):
    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.marks: list[tuple[str, str, str]] = []
        self.handle_data = lambda text: self.marks.append(("text", "", text))
        self.handle_endtag = lambda tag: self.marks.append(("close", tag, ""))
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.marks.append(("open", tag, next((value or "" for name, value in attrs if name == "href"), "")))


def _spaced(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def _links_of(marks: list[tuple[str, str, str]]) -> list[Link]:
    """The links of some marks; one that is never closed ends where the next begins."""
    starts = [n for n, (kind, tag, href) in enumerate(marks) if kind == "open" and tag == "a" and href]
    out = []
    for at, following in zip(starts, [*starts[1:], len(marks)], strict=False):
        end = next((n for n in range(at, following) if marks[n][:2] == ("close", "a")), following)
        out.append(Link(marks[at][2].strip(), _spaced([text for kind, _, text in marks[at:end] if kind == "text"])))
    return out


def cells(html: str) -> list[list[list[Cell]]]:
    """The tables of a page as rows of cells, in the order in which they end; a nested table is a table of its own and no text of its cell.

    Tags that are never closed end with what holds them.
    """
    finished: list[list[list[Cell]]] = []
    nest: list[dict] = []

    def end_cell(table: dict) -> None:
        if table["marks"] is not None:
            table["rows"][-1].append(Cell(_spaced([t if k == "text" else " " for k, _, t in table["marks"]]), tuple(_links_of(table["marks"]))))
            table["marks"] = None

    def end_table() -> None:
        table = nest.pop()
        end_cell(table)
        finished.append([r for r in table["rows"] if r])

    for mark in _Marks(html).marks:
        kind, tag, _ = mark
        if kind == "open" and tag == "table":
            nest.append({"rows": [], "marks": None})
        elif nest and tag in _BLOCKS:
            table = nest[-1]
            if tag == "table":
                end_table()
            else:
                end_cell(table)
                if kind == "open" and tag == "tr":
                    table["rows"].append([])
                elif kind == "open":
                    table["rows"] = table["rows"] or [[]]
                    table["marks"] = []
        elif nest and nest[-1]["marks"] is not None:
            nest[-1]["marks"].append(mark)
    while nest:
        end_table()
    return [t for t in finished if t]


def tables(html: str) -> list[list[list[str]]]:
    """The tables of a page as rows of cell texts."""
    return [[[cell.text for cell in row] for row in table] for table in cells(html)]


def _kind(address: str, hosts: frozenset[str]) -> str:
    parts = urlsplit(address)
    if parts.hostname not in hosts:
        return "external"
    return "document" if parts.path.lower().endswith(DOCUMENT_SUFFIXES) else "page"


def links(html: str, page: str, hosts: frozenset[str], wanted: str | None = None, unwanted: str | None = None, scope: str | None = None) -> list[tuple[str, str, str]]:
    """(address, text, kind) of a page's links, once each: document, page, or external to the hosts.

    wanted, unwanted: patterns that a link's text and path must and must not hold, whatever the case. scope: a pattern of the beginning of a
    path; where the page's own path has one, only pages below the same beginning count.
    """
    found: dict[str, tuple[str, str, str]] = {}
    own = re.match(scope, urlsplit(page).path, re.I) if scope else None
    for link in _links_of(_Marks(html).marks):
        address = urljoin(page, link.href).split("#")[0]
        parts = urlsplit(address)
        spoken = f"{link.text} {parts.path}"
        if parts.scheme not in ("http", "https") or (wanted and not re.search(wanted, spoken, re.I)) or (unwanted and re.search(unwanted, spoken, re.I)):
            continue
        kind = _kind(address, hosts)
        if kind != "page" or not own or parts.path.lower().startswith(own[0].lower()):
            found.setdefault(address, (address, link.text, kind))
    return list(found.values())


def page_links(pages: DataFrame, url: str, html: str, hosts: frozenset[str], **filters: str) -> DataFrame:
    """Links of each page: page, position, address, text, kind. filters: see ``links``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(u, n, *link) for u, h in zip(batch.url, batch.html, strict=True) for n, link in enumerate(links(h or "", u or "", hosts, **filters))]
            yield pd.DataFrame(rows, columns=["page", "position", "address", "text", "kind"])

    shipped(pages.sparkSession)
    return pages.select(F.col(url).alias("url"), F.col(html).alias("html")).mapInPandas(run, "page string, position int, address string, text string, kind string")


def index_rows(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Rows of every table of each page: page, table, row, ``texts`` of the cells and ``addresses``, the first link of each cell made absolute, NULL without one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (u, t, r, [c.text for c in row], [urljoin(u or "", c.links[0].href) if c.links else None for c in row])
                for u, h in zip(batch.url, batch.html, strict=True)
                for t, table in enumerate(cells(h or ""))
                for r, row in enumerate(table)
            ]
            yield pd.DataFrame(rows, columns=["page", "table", "row", "texts", "addresses"])

    shipped(pages.sparkSession)
    return pages.select(F.col(url).alias("url"), F.col(html).alias("html")).mapInPandas(run, "page string, table int, row int, texts array<string>, addresses array<string>")


def index_entries(rows: DataFrame, name: int, title: int, address: int, titled: str, header: str) -> DataFrame:
    """Entries of index rows: page, name, title, address. Columns are by position; rows without name or address, with a title not holding ``titled`` or the ``header`` as name are none."""
    at = lambda c, n: F.try_element_at(F.col(c), F.lit(n + 1))
    found = rows.select("page", at("texts", name).alias("name"), at("texts", title).alias("title"), at("addresses", address).alias("address"))
    return found.filter((F.col("name") != "") & (F.lower("name") != header.lower()) & F.lower("title").contains(titled.lower()) & F.col("address").isNotNull())


def frontier(pages: DataFrame, seeds: DataFrame, hosts: frozenset[str], depth: int, **filters: str) -> DataFrame:
    """Addresses reachable from the seeds over stored pages (url, html) within ``depth`` steps, with their least depth: address, depth.

    Pages are read once, whatever the depth.
    """
    edges = written(page_links(pages, "url", "html", hosts, **filters).filter("kind <> 'external'").select("page", "address").distinct(), "page-links")
    seen = seeds.select(F.col("address"), F.lit(0).alias("depth"))
    front = seen
    for n in range(1, depth + 1):
        step = front.select(F.col("address").alias("page")).join(edges, "page").select("address").distinct().join(seen.select("address"), "address", "left_anti").withColumn("depth", F.lit(n))
        front = written(step, "frontier")
        seen = seen.unionByName(front)
    return seen
