"""Fields of HTML pages: flat anchors by pattern, nested sections by a parser in Arrow batches."""

from __future__ import annotations

import json
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terrace.functions.text import collapsed, name_and_symbol

HREF = r'<a\s[^>]*?href="([^"]*)"'
BLOCKS = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "br", "tr", "section"}
SILENT = {"script", "style"}


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, position (from 0) and href of every anchor."""
    return pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(1))).alias("position", "href"))


class _Section(HTMLParser):
    """Text of the first outermost section tag, its blocks joined by two spaces, and its links by text."""

    def __init__(self, tag: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.depth, self.quiet, self.done, self.parts, self.now = tag, 0, 0, False, [], []
        self.href, self.label, self.found = None, [], {}

    def _flush(self) -> None:
        text = " ".join("".join(self.now).split())
        if text:
            self.parts.append(text)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag == self.tag:
            self.depth += 1
        elif self.depth:
            self.quiet += tag in SILENT
            if tag in BLOCKS:
                self._flush()
            if tag == "a":
                self.href, self.label = dict(attrs).get("href") or "", []

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if tag == "a" and self.href is not None:
            self.found.setdefault(" ".join("".join(self.label).split()), self.href)
            self.href = None
        self.quiet -= tag in SILENT and self.quiet > 0
        if tag in BLOCKS:
            self._flush()
        if tag == self.tag:
            self.depth -= 1
            if not self.depth:
                self._flush()
                self.done = True

    def handle_data(self, data):
        if self.depth and not self.quiet and not self.done:
            self.now.append(data)
            self.label.append(data)


def section(html: Column, tag: str = "article") -> Column:
    """struct<text, links>: a section's text and its links as a JSON object, the first of a label; empty without one."""

    @F.pandas_udf("text string, links string")
    def read(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            parser = _Section(tag)
            parser.feed(page or "")
            parser.close()
            parser._flush()
            rows.append(("  ".join(parser.parts), json.dumps(parser.found, ensure_ascii=False)))
        return pd.DataFrame(rows, columns=["text", "links"])

    return read(html)


class _Rows(HTMLParser):
    """Rows of a label and links: boxes of a class, within them a label box of a class, one level down."""

    def __init__(self, tag: str, row_classes: set[str], label_class: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.row_classes, self.label_class = tag, row_classes, label_class
        self.depth, self.row, self.label, self.rows = 0, None, None, []
        self.words, self.href, self.text = [], None, []

    def handle_starttag(self, tag, attrs):
        named = {k.lower(): v or "" for k, v in attrs}
        if tag == self.tag:
            self.depth += 1
            classes = set(named.get("class", "").split())
            if self.row is None and self.row_classes <= classes:
                self.row, self.label = self.depth, None
                self.rows.append(["", []])
            elif self.row is not None and self.label is None and self.depth == self.row + 1 and self.label_class in classes:
                self.label, self.words = self.depth, []
        elif tag == "a" and self.row is not None and (href := named.get("href", "").strip()):
            self.href, self.text = href, []

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            if self.row is not None:
                self.rows[-1][1].append((" ".join(" ".join(self.text).split()), self.href))
            self.href = None
        elif tag == self.tag and self.depth:
            if self.label == self.depth:
                self.rows[-1][0] = " ".join(" ".join(self.words).split())
                # A row's label is what its last label box says.
                self.label = None
            if self.row == self.depth:
                self.row = self.label = self.href = None
            self.depth -= 1

    def handle_data(self, data):
        if self.label is not None:
            self.words.append(data)
        if self.href is not None:
            self.text.append(data)


def labelled_rows(html: Column, row_classes: list[str], label_class: str, tag: str = "div") -> Column:
    """array<struct<label, links: array<struct<text, href>>>> of a page's labelled rows, in page order.

    A row is a box with all of row_classes that lies in no other row; its label is the text of a box with label_class
    right inside it; its links are the anchors with an href that begin behind the label. Texts are collapsed. Null and
    empty pages have no rows. One parse serves all labels.
    """

    @F.pandas_udf("array<struct<label string, links array<struct<text string, href string>>>>")
    def read(pages: pd.Series) -> pd.Series:
        def one(page):
            parser = _Rows(tag, set(row_classes), label_class)
            parser.feed(page or "")
            parser.close()
            return [{"label": label, "links": [{"text": t, "href": h} for t, h in links]} for label, links in parser.rows]

        return pages.map(one)

    return read(html)


def _links_of(rows: Column, label: str) -> Column:
    return F.flatten(F.transform(F.filter(rows, lambda r: r["label"] == label), lambda r: r["links"]))


def label_list(rows: Column, label: str, href_prefix: str = "") -> Column:
    """A JSON list of the texts of a label's links, each once in page order; only links whose href begins so count."""
    kept = F.filter(_links_of(rows, label), lambda x: (x["text"] != "") & F.startswith(x["href"], F.lit(href_prefix)))
    return F.to_json(F.array_distinct(F.transform(kept, lambda x: x["text"])))


def label_map(rows: Column, label: str) -> Column:
    """A JSON object of the hrefs of a label's links by text, of equal texts the first."""
    kept = F.filter(_links_of(rows, label), lambda x: x["text"] != "")
    names = F.array_distinct(F.transform(kept, lambda x: x["text"]))
    first = F.transform(names, lambda n: F.struct(n, F.element_at(F.filter(kept, lambda x: x["text"] == n), 1)["href"]))
    return F.to_json(F.map_from_entries(first))


def anchors(pages: DataFrame, key: str, html: str, path: str) -> DataFrame:
    """key, position (of the first such anchor), name, symbol and href of the links to a path, each once for a page.

    A link's text is what lies between its tags, pieces joined by single spaces; links whose text doesn't end in a symbol
    are left out.
    """
    found = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<a\b[^>]*>.*?</a\s*>"), F.lit(0))).alias("position", "_a"))
    href = F.trim(plain(F.regexp_extract("_a", r"(?is)^<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"']", 1)))
    text = plain(F.regexp_replace(F.regexp_replace("_a", r"(?s)<!--.*?-->", ""), r"(?s)<[^>]*>", " "))
    named = found.select(key, "position", href.alias("href"), name_and_symbol(text).alias("_n")).where(F.contains("href", F.lit(path)) & (F.col("_n.symbol") != ""))
    return named.groupBy(key, F.col("_n.name").alias("name"), F.col("_n.symbol").alias("symbol"), "href").agg(F.min("position").alias("position")).select(key, "position", "name", "symbol", "href")


@lru_cache
def _decoded():
    @F.pandas_udf(StringType())
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else " ".join(unescape(t).split()))

    return read


def plain(text: Column) -> Column:
    """Entities replaced by their characters, runs of white space and no-break spaces by one space, none at the ends.

    Texts without an ampersand stay in the engine.
    """
    coded = F.contains(text, F.lit("&"))
    return F.when(text.isNull(), F.lit(None)).when(coded, _decoded()(F.when(coded, text))).otherwise(collapsed(text))
