"""Titles and keywords out of feeds, web pages and model replies, as whole-table jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions import text as tx
from trendloom.sources import selectors as selector

_ITEMS = "array<struct<title: string>>"
_FEED = f"channel struct<item: {_ITEMS}>, item {_ITEMS}, entry {_ITEMS}"


def feed_titles(feeds: DataFrame, atom_marks: Sequence[str] | None = None) -> DataFrame:
    """(source, url, pos, title) from a table of feed documents (source, url, xml).

    Atom entries are taken where the url holds one of ``atom_marks`` (anywhere if None),
    RSS items otherwise or when there was no entry. Broken documents give no rows.
    """
    parsed = F.from_xml(F.col("xml"), _FEED, {"mode": "PERMISSIVE"})

    def titles(items):
        found = F.transform(F.coalesce(items, F.array().cast(_ITEMS)), lambda i: i["title"])
        return F.filter(found, lambda t: t.isNotNull() & (t != ""))

    with_feed = feeds.select("source", "url", parsed.alias("feed")).select(
        "source",
        "url",
        titles(F.col("feed.entry")).alias("atom"),
        F.concat(titles(F.col("feed.channel.item")), titles(F.col("feed.item"))).alias("rss"),
    )
    wanted = F.lit(True) if atom_marks is None else F.coalesce(
        tx.contains_any(F.col("url"), atom_marks), F.lit(False)
    )
    chosen = F.when(wanted & (F.size("atom") > 0), F.col("atom")).otherwise(F.col("rss"))
    return with_feed.select("source", "url", F.posexplode(chosen).alias("pos", "title"))


def page_titles(
    pages: DataFrame, selectors: Sequence[str], per_page: int | None = None, html: str = "html"
) -> DataFrame:
    """The page columns without the html, plus (pos, title) per element found.

    The first selector that matches is used. ``per_page`` keeps the first titles of a page,
    as one page form asks for. Empty titles are left out.
    """
    compiled = [selector.compile_selector(s) for s in selectors]
    return _titles(pages, html, lambda h: [f.text for f in selector.find(h, compiled)][:per_page])


def page_rows(
    pages: DataFrame, rows: Sequence[str], cell: str, per_page: int | None = None, html: str = "html"
) -> DataFrame:
    """The page columns without the html, plus (pos, title): the first ``cell`` inside each row.

    The first row selector that matches is used; ``per_page`` keeps the first rows of a page, with
    or without a cell. Rows without a cell and empty titles are left out; ``pos`` is the row's place.
    """
    compiled, inner = [selector.compile_selector(s) for s in rows], selector.compile_selector(cell)

    def texts(h):
        return [f.cell.text if f.cell else "" for f in selector.find(h, compiled, inner)][:per_page]

    return _titles(pages, html, texts)


def _titles(pages: DataFrame, html: str, texts: Callable[[str | None], list[str]]) -> DataFrame:
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(texts)

    rest = [f"`{c}`" for c in pages.columns if c != html]
    return pages.select(*rest, F.posexplode(find(F.col(html))).alias("pos", "title")).filter(F.col("title") != "")


def keyword_replies(replies: DataFrame, column: str = "text") -> DataFrame:
    """(reply_id, pos, keyword) from model replies that hold a one-column table.

    Code fences, everything from '}}' to the end of a line, blank lines and trailing commas
    go away; the first line left is the header.
    """
    fences = F.regexp_replace(F.regexp_replace(F.col(column), "```csv", ""), "```", "")
    cut = F.regexp_replace(fences, r"\}\}[^\n]*", "")
    lines = F.filter(F.transform(F.split(cut, "\n"), tx.squash), lambda line: line != "")
    numbered = replies.select("reply_id", F.posexplode(lines).alias("pos", "line"))
    keyword = tx.squash(F.regexp_replace("line", r"[,\s]+$", ""))
    return (
        numbered.filter(F.col("pos") > 0)
        .select("reply_id", "pos", keyword.alias("keyword"))
        .filter(F.col("keyword") != "")
    )
