"""Titles and keywords out of feeds, pages and replies."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendloom.plans.catalog.base import query, table
from trendloom.sources import texts

# One feed document per text: RSS, Atom with its namespace, broken, or with an empty title.
_ITEM = "trim(regexp_replace(text, '[^a-zA-Z ]', ' '{g}))"


def _feeds(spark, sf_dir):
    item = F.expr(_ITEM.format(g=""))
    kind = F.col("doc_id") % 4
    rss = F.concat(
        F.lit("<rss version='2.0'><channel><title>c</title><item><title>"),
        item,
        F.lit("</title><link>l</link></item><item><title></title></item><item><title>Q &amp; A</title></item></channel></rss>"),
    )
    atom = F.concat(
        F.lit("<feed xmlns='http://www.w3.org/2005/Atom'><title>f</title><entry><title>"),
        item,
        F.lit("</title><id>1</id></entry></feed>"),
    )
    broken = F.concat(F.lit("<rss><channel><item><title>"), item)
    both = F.concat(
        F.lit("<feed><entry><title>E</title></entry><channel><item><title>"),
        item,
        F.lit("</title></item></channel></feed>"),
    )
    xml = F.when(kind == 0, rss).when(kind == 1, atom).when(kind == 2, broken).otherwise(both)
    url = F.concat(F.when(kind == 1, "http://d2.example/").otherwise("http://e/"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("source", url.alias("url"), xml.alias("xml"))


@query(
    f"""WITH d AS (SELECT source, doc_id % 4 AS kind, concat(CASE WHEN doc_id % 4 = 1
        THEN 'http://d2.example/' ELSE 'http://e/' END, CAST(doc_id AS VARCHAR)) AS url,
        {_ITEM.format(g=", 'g'")} AS item FROM documents),
    t AS (SELECT source, url, kind, 0 AS n, item AS title FROM d WHERE kind <> 2
      UNION ALL SELECT source, url, kind, 1, 'Q & A' FROM d WHERE kind = 0)
    SELECT source, url, title FROM t WHERE title <> ''"""
)
def feed_titles(spark, sf_dir):
    return texts.feed_titles(_feeds(spark, sf_dir), ["d2.example"]).select("source", "url", "title")


def _unescape(html: str) -> str:
    for entity, sign in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"), ("&amp", "&")):
        html = f"replace({html}, '{entity}', '{sign}')"
    return f"trim({html})"


@query(
    f"""SELECT page_id, CAST(0 AS INTEGER) AS pos,
      {_unescape("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} AS title FROM pages"""
)
def page_titles(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", spread=True).select("page_id", "html")
    return texts.page_titles(pages, ["article.post h2", "article h1"])


@query(
    f"""WITH l AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1),
        '<a[^>]*>(.*?)</a>', 1) AS links FROM pages),
    e AS (SELECT page_id, unnest(range(0, least(len(links), 3))) AS pos, links FROM l)
    SELECT page_id, CAST(pos AS INTEGER) AS pos, {_unescape("links[pos + 1]")} AS title FROM e"""
)
def page_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", spread=True).select("page_id", "html")
    return texts.page_titles(pages, ["nav li a"], per_page=3)


@query(
    f"""WITH l AS (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1),
        '<a[^>]*>(.*?)</a>', 1) AS links FROM pages),
    e AS (SELECT page_id, unnest(range(0, least(len(links), 5))) AS pos, links FROM l)
    SELECT page_id, CAST(pos AS INTEGER) AS pos, {_unescape("links[pos + 1]")} AS title FROM e"""
)
def page_rows(spark, sf_dir):
    """Rows by the second selector, then the first cell of each."""
    pages = table(spark, sf_dir, "pages", spread=True).select("page_id", "html")
    return texts.page_rows(pages, ["nav > li.main", "nav li"], "ul > li > a[href]", per_page=5)


@query(
    f"""SELECT * FROM (SELECT page_id, CAST(0 AS INTEGER) AS pos,
        {_unescape("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title FROM pages
      UNION ALL SELECT page_id, CAST(1 AS INTEGER) AS pos,
        {_unescape("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} AS title FROM pages) WHERE title <> ''"""
)
def page_headings(spark, sf_dir):
    """Elements of a list of selectors, in the order of the page."""
    pages = table(spark, sf_dir, "pages", spread=True).select("page_id", "html")
    return texts.page_titles(pages, ["article > h1, head > title"])


_REPLY = "concat('```csv', chr(10), 'keyword', chr(10), text, ',', chr(10), '}}} end', chr(10), ' last }}x', chr(10), '```')"


@query(
    f"""WITH c AS (SELECT doc_id, regexp_replace(replace(replace({_REPLY}, '```csv', ''), '```', ''),
        '\\}}\\}}[^\\n]*', '', 'g') AS t FROM documents),
    l AS (SELECT doc_id, [x FOR x IN list_transform(string_split(t, chr(10)),
        lambda y: regexp_replace(y, '^\\s+|\\s+$', '', 'g')) IF x <> ''] AS ls FROM c),
    e AS (SELECT doc_id, unnest(range(1, len(ls))) AS pos, ls FROM l),
    k AS (SELECT doc_id AS reply_id, CAST(pos AS INTEGER) AS pos,
        regexp_replace(ls[pos + 1], '[,\\s]+$', '') AS keyword FROM e)
    SELECT reply_id, pos, md5(regexp_replace(keyword, '^\\s+|\\s+$', '', 'g')) AS keyword_md5
    FROM k WHERE keyword <> ''"""
)
def keyword_replies(spark, sf_dir):
    replies = table(spark, sf_dir, "documents", spread=True).select(
        F.col("doc_id").alias("reply_id"), F.expr(_REPLY).alias("text")
    )
    return texts.keyword_replies(replies).select("reply_id", "pos", F.md5("keyword").alias("keyword_md5"))
