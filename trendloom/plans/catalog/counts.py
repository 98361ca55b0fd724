"""Abbreviated counts and the extraction of posts and video rows from raw crawl tables.

The raw strings are derived from ids and lengths by one CASE that both engines understand.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trendloom.functions import counts
from trendloom.plans.catalog.base import query, table
from trendloom.sources import extract

_RAW = """CASE {i} % 14
  WHEN 0 THEN CAST({n} AS STRING)
  WHEN 1 THEN concat(CAST(CAST(floor({n} / 1000) AS BIGINT) AS STRING), ',',
                     lpad(CAST({n} % 1000 AS STRING), 3, '0'))
  WHEN 2 THEN concat(CAST({n} % 1000 AS STRING), '.', CAST({i} % 10 AS STRING), 'K')
  WHEN 3 THEN concat(CAST({n} % 100 AS STRING), 'M')
  WHEN 4 THEN concat(CAST({n} % 100 AS STRING), '.', CAST({n} % 10 AS STRING), '만')
  WHEN 5 THEN concat('조회수 ', CAST({n} % 100 AS STRING), '.', CAST({n} % 10 AS STRING), '만회')
  WHEN 6 THEN concat('구독자 ', CAST({n} AS STRING), '명')
  WHEN 7 THEN 'abc'
  WHEN 8 THEN concat(CAST({n} % 10 AS STRING), '.2.3')
  WHEN 9 THEN CAST(NULL AS STRING)
  WHEN 10 THEN concat(CAST({n} % 10 AS STRING), '.5백만')
  WHEN 11 THEN concat(CAST({n} % 30 AS STRING), '억')
  WHEN 12 THEN concat('조회수 ', CAST({n} AS STRING), '회')
  ELSE concat(CAST({n} AS STRING), ' views') END"""


def raw(i: str, n: str) -> str:
    return _RAW.format(i=i, n=n)


def _strip(text: str, words) -> str:
    for word in words:
        text = f"replace({text}, '{word}', '')"
    return text


def _number(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({text}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
        f"THEN TRY_CAST(trim({text}) AS DOUBLE) END"
    )


# Per dialect: words dropped, (markers, factor) in order, pattern of plain digits.
_RULES = {
    "post": ([","], [(["K"], 1e3), (["M"], 1e6)], "[0-9]+"),
    "author": ([","], [(["K"], 1e3), (["M"], 1e6), (["만"], 1e4)], "[0-9.]+"),
    "video": (
        [",", "회", "views", "subscribers", "구독자", "명"],
        [(["만"], 1e4), (["억"], 1e8), (["K", "천"], 1e3), (["M", "백만"], 1e6)],
        "[0-9.]+",
    ),
    "video_fixed": (
        ["조회수", ",", "회", "views", "subscribers", "구독자", "명"],
        [(["M", "백만"], 1e6), (["만"], 1e4), (["억"], 1e8), (["K", "천"], 1e3)],
        "[0-9.]+",
    ),
}


def count_sql(text: str, dialect: str) -> str:
    """DuckDB expression of the whole number in ``text``."""
    drop, units, digits = _RULES[dialect]
    body = f"trim({_strip(f'({text})', drop)})"
    cases = []
    for markers, factor in units:
        test = " OR ".join(f"contains({body}, '{m}')" for m in markers)
        number = _number(_strip(body, markers))
        cases.append(f"WHEN {test} THEN trunc(({number}) * {factor:.1f})")
    plain = f"regexp_extract({body}, '{digits}')"
    return (
        f"coalesce(CAST(CASE {' '.join(cases)} ELSE trunc({_number(plain)}) END AS BIGINT), "
        "CAST(0 AS BIGINT))"
    )


def _raw_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.expr(raw("doc_id", "n_chars")).alias("raw"))


def _register_dialects():
    for dialect in _RULES:
        sql = (
            f"SELECT doc_id, raw, {count_sql('raw', dialect)} AS value FROM "
            f"(SELECT doc_id, {raw('doc_id', 'n_chars')} AS raw FROM documents)"
        )

        def run(spark, sf_dir, dialect=dialect):
            rows = _raw_table(spark, sf_dir).withColumn("value", F.col("raw"))
            return counts.normalise_counts(rows, ["value"], dialect, None)

        query(sql, f"normalise_counts_{dialect}")(run)


_register_dialects()


@query(
    f"""WITH r AS (SELECT {raw('doc_id', 'n_chars')} AS raw, doc_id % 14 AS kind FROM documents)
    SELECT CASE WHEN kind = 9 THEN 'empty' WHEN kind = 7 THEN 'none'
      WHEN kind IN (5, 8, 10) THEN 'failed' WHEN kind IN (2, 3, 4, 11) THEN 'unit'
      ELSE 'digits' END AS status, count(*) AS n FROM r GROUP BY 1"""
)
def parse_report(spark, sf_dir):
    return counts.parse_report(_raw_table(spark, sf_dir), "raw", "video")


_SOURCE = """CASE doc_id % 5
  WHEN 0 THEN concat('{"viewCount":"', CAST(n_chars AS STRING), '","followers_count":  ',
                     CAST(doc_id AS STRING), '}')
  WHEN 1 THEN concat('{"originalViewCount":"', CAST(n_chars AS STRING), '"}')
  WHEN 2 THEN concat('{"viewCount":{"simpleText":"', CAST(n_chars % 100 AS STRING), '.5만회"}}')
  WHEN 3 THEN concat(text, '"followers_count":', CAST(n_chars AS STRING))
  ELSE text END"""


@query(
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN n_chars WHEN 1 THEN n_chars
        WHEN 2 THEN CAST(trunc(CAST(concat(CAST(n_chars % 100 AS VARCHAR), '.5') AS DOUBLE) * 10000.0)
             AS BIGINT) ELSE 0 END AS views,
      CASE doc_id % 5 WHEN 0 THEN doc_id WHEN 3 THEN n_chars ELSE 0 END AS followers
    FROM documents"""
)
def count_from_source(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.expr(_SOURCE).alias("source_text"))
    return rows.select(
        "doc_id",
        extract.count_from_source(F.col("source_text")).alias("views"),
        extract.followers_from_source(F.col("source_text")).alias("followers"),
    )


# Raw video pages out of documents: one page per document, its lines as comments.
def _raw_videos(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True)
    lines = F.split("text", "\n")
    number = F.col("doc_id").cast("string")
    kind = F.col("doc_id") % 4
    none = F.array().cast("array<string>")
    label = F.struct(F.lit("공유").alias("text"), F.lit("share 77").alias("label"))
    return docs.select(
        F.col("doc_id").alias("seq"),
        F.lit("kw").alias("search_keyword"),
        F.concat(F.lit("video "), number).alias("title"),
        F.concat(F.lit("/watch?v="), number).alias("url"),
        F.get(lines, F.lit(0)).alias("description"),
        F.concat(F.lit('x"originalViewCount":"'), number, F.lit('"')).alias("page_source"),
        F.when(
            kind == 0,
            F.array(
                F.lit("조회수 없음"), F.concat(F.lit(" 조회수 "), number, F.lit("회 ")), F.lit("조회수 3주 전")
            ),
        )
        .when(kind == 1, F.array(F.lit("5일 전 스트리밍"), F.lit("2 years ago"), F.lit("1.5K views")))
        .when(kind == 2, F.array(F.lit(""), F.lit("최초 공개: 2024. 1. 3.")))
        .otherwise(none)
        .alias("info_lines"),
        F.when(
            kind < 2,
            F.array(label, F.struct(F.concat(number, F.lit("천")).alias("text"), F.lit("x").alias("label"))),
        )
        .when(
            kind == 2,
            F.array(
                label,
                F.struct(
                    F.lit("").alias("text"), F.concat(F.lit("Like, 1,"), number).alias("label")
                ),
            ),
        )
        .otherwise(F.array(label))
        .alias("like_candidates"),
        F.when(kind == 3, F.array(F.lit("none"), F.lit("7 views"))).otherwise(none).alias("view_texts"),
        F.array(F.lit(""), F.concat(F.lit("구독자 "), number, F.lit("만명"))).alias("subscriber_texts"),
        F.transform(
            lines,
            lambda line, i: F.struct(
                line.alias("text"),
                F.concat(F.lit(" a"), i.cast("string")).alias("author"),
                F.lit("3주 전").alias("published"),
            ),
        ).alias("comments"),
    )


_FIELDS_SQL = """SELECT doc_id,
    CASE doc_id % 4 WHEN 0 THEN CASE WHEN doc_id > 0 THEN '조회수 3주 전' END WHEN 1 THEN '2 years ago'
      WHEN 2 THEN '최초 공개: 2024. 1. 3.' END AS video_published_date,
    CASE doc_id % 4 WHEN 0 THEN doc_id * 1000 WHEN 1 THEN doc_id * 1000
      WHEN 2 THEN CAST(concat('1', CAST(doc_id AS VARCHAR)) AS BIGINT) ELSE 0 END AS video_likes,
    CASE doc_id % 4 WHEN 0 THEN CASE WHEN doc_id > 0 THEN doc_id ELSE 3 END WHEN 1 THEN 1500
      WHEN 2 THEN doc_id ELSE CASE WHEN doc_id > 0 THEN doc_id ELSE 7 END END AS video_views,
    doc_id * 10000 AS channel_subscribers FROM documents"""


@query(_FIELDS_SQL)
def video_fields(spark, sf_dir):
    fields = extract.video_fields(_raw_videos(spark, sf_dir), "video_fixed")
    return fields.select(
        F.col("seq").alias("doc_id"),
        "video_published_date",
        "video_likes",
        "video_views",
        "channel_subscribers",
    )


@query(
    f"""WITH f AS ({_FIELDS_SQL}), l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
    c AS (SELECT doc_id, ls[pos] AS text, pos FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS pos FROM l)),
    r AS (SELECT doc_id, 0 AS seq, 'Uploader(Desc)' AS author, text, 'description' AS type
          FROM c WHERE pos = 1 AND length(text) > 50
          UNION ALL SELECT doc_id, pos, concat('a', CAST(pos - 1 AS VARCHAR)), text, 'comment' FROM c)
    SELECT concat('/watch?v=', CAST(doc_id AS VARCHAR)) AS video_url, CAST(seq AS INTEGER) AS seq,
      author, md5(text) AS comment_md5, type, CASE WHEN type = 'comment' THEN '3주 전' END AS comment_date,
      '2024-02-01' AS crawled_at, video_published_date, video_likes, video_views, channel_subscribers
    FROM r JOIN f USING (doc_id)"""
)
def video_rows(spark, sf_dir):
    rows = extract.video_rows(_raw_videos(spark, sf_dir), "2024-02-01", dialect="video_fixed")
    return rows.select(
        "video_url",
        "seq",
        "author",
        F.md5("comment").alias("comment_md5"),
        "type",
        "comment_date",
        "crawled_at",
        "video_published_date",
        "video_likes",
        "video_views",
        "channel_subscribers",
    )


_CARDS = {
    "seq": "doc_id",
    "search_query": "source",
    "text": "CASE WHEN doc_id % 9 = 0 THEN '' ELSE text END",
    "datetime": "CASE WHEN doc_id % 3 = 0 THEN CAST(NULL AS STRING) ELSE '2024-01-05T10:00:00.000Z' END",
    "reply_label": raw("doc_id", "n_chars"),
    "retweet_label": raw("(doc_id + 1)", "n_chars"),
    "like_label": "CASE WHEN doc_id % 2 = 0 THEN CAST(NULL AS STRING) ELSE '12 Likes' END",
    "unlike_label": "concat(CAST(n_chars AS STRING), ' liked')",
    "view_label": raw("(doc_id + 2)", "n_chars"),
    "author_url": "CASE WHEN doc_id % 7 = 0 THEN CAST(NULL AS STRING) ELSE concat('https://x.com/', source) END",
}


@query(
    f"""WITH c AS (SELECT {", ".join(f"{sql} AS {name}" for name, sql in _CARDS.items())} FROM documents)
    SELECT seq, search_query, text, coalesce(datetime, '2024-02-01T00:00:00') AS created_at,
      {count_sql('reply_label', 'post')} AS reply, {count_sql('retweet_label', 'post')} AS retweet,
      CASE WHEN like_label IS NULL THEN {count_sql('unlike_label', 'post')} ELSE 12 END AS "like",
      {count_sql('view_label', 'post')} AS view,
      CASE WHEN author_url IS NULL THEN 'unknown' ELSE concat('@', search_query) END AS author_id
    FROM c WHERE text <> ''"""
)
def post_card(spark, sf_dir):
    cards = table(spark, sf_dir, "documents").select(
        *[F.expr(sql).alias(name) for name, sql in _CARDS.items()]
    )
    return extract.post_card(cards, "2024-02-01T00:00:00")
