"""Download-link index from HTML pages held in a DataFrame.

Two rules:

* ``table_links`` -- the published-index rule: in the first
  ``<table class="table">`` of a page, skip the first row, take the first
  cell of each other row, rows of nested tables included, and its first
  anchor -> (name = anchor text, url = href); rows whose first cell has no
  anchor are dropped.  An anchor that is not closed ends with its cell.  Needs
  an HTML parser, so it runs per batch of pages in ``mapInPandas`` (stdlib
  parser, no driver round trip).
* ``anchor_links`` -- every ``<a .. href=..>text</a>`` of a page, in page order,
  with built-in ``regexp_extract_all`` + ``posexplode`` (JVM only); tags inside
  the text are taken out.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.routing import link_kept

LINK_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("url", T.StringType()),
])

ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))[^>]*>(.*?)</a\s*>"""


def anchor_links(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    html = F.col(html_col)
    group = lambda g: F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(g))
    # the URL is in one of three groups, by its quotes; the others are empty
    parts = F.arrays_zip(group(1).alias("a"), group(2).alias("b"), group(3).alias("c"), group(4).alias("t"))
    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.posexplode(parts).alias("pos", "x"))
            .select("page_id", F.col("pos").cast("int").alias("pos"),
                    F.regexp_replace("x.t", "<[^>]*>", "").alias("name"),
                    F.concat("x.a", "x.b", "x.c").alias("url")))


class _Row:
    """A table row being read: its first cell and that cell's first anchor."""

    def __init__(self):
        self.cell = None      # how many cells were open when the first began
        self.done = False     # the first cell has ended
        self.href = None
        self.text = None      # pieces of the anchor's text, once it has begun
        self.reading = False


class _IndexTable(HTMLParser):
    """Collects (name, url) per the published-index rule."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[_Row] = []      # in order of their start
        self.open: list[_Row] = []
        self.tables = self.cells = 0
        self.done = False

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag == "table" and (self.tables or "table" in (dict(attrs).get("class") or "").split()):
            self.tables += 1
        if not self.tables:
            return
        if tag == "tr":
            self.rows.append(_Row())
            self.open.append(self.rows[-1])
        elif tag == "td":
            for r in self.open:
                if r.cell is None:
                    r.cell = self.cells
            self.cells += 1
        elif tag == "a":
            for r in self.open:
                r.reading = False
                if r.cell is not None and not r.done and r.text is None:
                    r.href, r.text, r.reading = dict(attrs).get("href"), [], True

    def handle_endtag(self, tag):
        if self.done or not self.tables:
            return
        if tag == "a":
            for r in self.open:
                r.reading = False
        elif tag == "td" and self.cells:
            self.cells -= 1
            for r in self.open:
                if r.cell == self.cells:
                    r.done, r.reading = True, False
        elif tag == "tr" and self.open:
            r = self.open.pop()
            r.done, r.reading = True, False
        elif tag == "table":
            self.tables -= 1
            self.done = not self.tables

    def handle_data(self, data):
        if not self.done:
            for r in self.open:
                if r.reading:
                    r.text.append(data)


def parse_index_table(html: str) -> list[tuple[str, str]]:
    p = _IndexTable()
    p.feed(html or "")
    p.close()
    return [("".join(r.text), r.href) for r in p.rows[1:] if r.text is not None]


def _table_batches(batches):
    for pdf in batches:
        out = {"page_id": [], "pos": [], "name": [], "url": []}
        for pid, html in zip(pdf["page_id"], pdf["html"]):
            for i, (name, url) in enumerate(parse_index_table(html)):
                out["page_id"].append(int(pid))
                out["pos"].append(i)
                out["name"].append(name)
                out["url"].append(url)
        if out["page_id"]:
            yield pd.DataFrame(out, columns=["page_id", "pos", "name", "url"]).astype(
                {"page_id": "int64", "pos": "int32"})


def table_links(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"))
    return src.mapInPandas(_table_batches, LINK_SCHEMA)


def kept_links(links: DataFrame) -> DataFrame:
    """Drop links whose text names the excluded file family."""
    return links.filter(link_kept("name"))
