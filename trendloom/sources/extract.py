"""Raw crawl tables to typed rows: post cards to posts, video pages to video rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions import counts, text as tx
from trendloom.operators import dedup

# The marks that tell one kind of page text from another.
_VIEW_MARKS = ("조회수", "views")
_DATE_MARKS = ("전", "ago", "202")
_NOT_DATE = "스트리밍"
_LIKE_MARKS = ("좋아요", "like")
_UNIT_MARKS = ("천", "만", "K", "M")


def _any_of(text: Column, marks: tuple[str, ...]) -> Column:
    return tx.contains_any(text, marks)


def _video_count(text: Column, dialect: str = "video") -> Column:
    return counts.count_value(text, dialect)


def count_from_source(source: Column, dialect: str = "video") -> Column:
    """View count in a page source, 0 when no pattern is there; the first pattern found decides."""
    plain = F.regexp_extract(source, r'"viewCount":"([0-9]+)"', 1)
    original = F.regexp_extract(source, r'"originalViewCount":"([0-9]+)"', 1)
    worded = F.regexp_extract(source, r'"viewCount":\{"simpleText":"(.*?)"\}', 1)
    found = (
        F.when(plain != "", plain.try_cast("bigint"))
        .when(original != "", original.try_cast("bigint"))
        .when(worded != "", _video_count(worded, dialect))
    )
    return F.coalesce(found, F.lit(0).cast("bigint"))


def followers_from_source(source: Column) -> Column:
    """Follower count in a page source, 0 when not there."""
    digits = F.regexp_extract(source, r'"followers_count":\s*([0-9]+)', 1)
    return F.coalesce(F.when(digits != "", digits.try_cast("bigint")), F.lit(0).cast("bigint"))


def video_info(lines: Column, dialect: str = "video") -> tuple[Column, Column]:
    """(views, published date) from the info lines of a video page.

    Views come from the first views line with a number above 0. The date is the first line
    that looks like one and was not needed for the search of the views.
    """
    marked = F.transform(
        F.transform(lines, tx.squash),
        lambda line, i: F.struct(
            line.alias("line"),
            i.alias("i"),
            _any_of(line, _VIEW_MARKS).alias("is_view"),
            F.when(_any_of(line, _VIEW_MARKS), _video_count(line, dialect))
            .otherwise(F.lit(0).cast("bigint"))
            .alias("views"),
        ),
    )
    first_views = F.get(F.filter(marked, lambda m: m["views"] > 0), F.lit(0))
    views = F.coalesce(first_views["views"], F.lit(0).cast("bigint"))
    seen_at = F.coalesce(first_views["i"], F.lit(2**31 - 1))

    def is_date(m: Column) -> Column:
        used = m["is_view"] & (m["i"] <= seen_at)
        looks = _any_of(m["line"], _DATE_MARKS) & ~F.contains(m["line"], F.lit(_NOT_DATE))
        return ~used & looks

    return views, F.get(F.filter(marked, is_date), F.lit(0))["line"]


def likes_from_labels(candidates: Column, dialect: str = "video") -> Column:
    """The first number above 0 over (text, label) candidates; a text goes before its label."""

    def read(c: Column) -> Column:
        text, label = tx.squash(c["text"]), c["label"]
        usable = text.rlike("^[0-9]+$") | _any_of(text, _UNIT_MARKS)
        labelled = _any_of(F.lower(label), _LIKE_MARKS)
        none = F.lit(0).cast("bigint")
        return F.array(
            F.when(usable, _video_count(text, dialect)).otherwise(none),
            F.when(labelled, _video_count(label, dialect)).otherwise(none),
        )

    values = F.filter(F.flatten(F.transform(candidates, read)), lambda v: v > 0)
    return F.coalesce(F.get(values, F.lit(0)), F.lit(0).cast("bigint"))


def _first_view_text(texts: Column, dialect: str) -> Column:
    hit = F.get(F.filter(texts, lambda t: _any_of(t, _VIEW_MARKS)), F.lit(0))
    return _video_count(hit, dialect)


def video_fields(videos: DataFrame, dialect: str = "video") -> DataFrame:
    """Add video_published_date, video_likes, video_views and channel_subscribers.

    Views fall back to the page source and then to the view texts while they are 0.
    """
    shown, published = video_info(F.col("info_lines"), dialect)
    in_source = count_from_source(F.col("page_source"), dialect)
    in_texts = _first_view_text(F.col("view_texts"), dialect)
    subscriber_text = F.get(F.filter("subscriber_texts", lambda t: t != ""), F.lit(0))
    return videos.withColumns({"_shown": shown, "_source": in_source}).withColumns(
        {
            "video_published_date": published,
            "video_likes": likes_from_labels(F.col("like_candidates"), dialect),
            "video_views": F.when(F.col("_shown") > 0, F.col("_shown"))
            .when(F.col("_source") > 0, F.col("_source"))
            .otherwise(in_texts),
            "channel_subscribers": _video_count(subscriber_text, dialect),
        }
    ).drop("_shown", "_source")


def video_rows(
    videos: DataFrame, crawled_at: str, min_description: int = 50, dialect: str = "video"
) -> DataFrame:
    """One row per long description and per comment, with the video's fields on each.

    ``seq`` orders the rows of a video: the description first, then comments as found.
    The length and number limits on comments are those of operators.keywords.comments_limit.
    """
    fields = video_fields(videos, dialect)
    named = fields.withColumnsRenamed({"title": "video_title", "url": "video_url"}).withColumn(
        "crawled_at", F.lit(crawled_at)
    )
    shared = [
        "search_keyword",
        "video_title",
        "video_url",
        "video_published_date",
        "video_likes",
        "video_views",
        "channel_subscribers",
        "crawled_at",
    ]
    described = named.filter(F.length("description") > min_description).select(
        *shared,
        F.lit(0).alias("seq"),
        F.lit("Uploader(Desc)").alias("author"),
        F.col("description").alias("comment"),
        F.lit("description").alias("type"),
        F.lit(None).cast("string").alias("comment_date"),
    )
    commented = named.select(*shared, F.posexplode("comments").alias("_pos", "_c")).select(
        *shared,
        (F.col("_pos") + 1).alias("seq"),
        F.coalesce(tx.squash(F.col("_c.author")), F.lit("unknown")).alias("author"),
        F.col("_c.text").alias("comment"),
        F.lit("comment").alias("type"),
        F.col("_c.published").alias("comment_date"),
    )
    return dedup.union_by_name([described, commented])


def post_card(cards: DataFrame, ingest_time: str) -> DataFrame:
    """Raw cards to posts. Cards without text go; a card without time gets ``ingest_time``."""
    like = F.when(F.col("like_label").isNotNull(), F.col("like_label")).otherwise(F.col("unlike_label"))
    return cards.filter(F.col("text") != "").select(
        "seq",
        "search_query",
        "text",
        F.coalesce("datetime", F.lit(ingest_time)).alias("created_at"),
        counts.count_value(F.col("reply_label"), "post").alias("reply"),
        counts.count_value(F.col("retweet_label"), "post").alias("retweet"),
        counts.count_value(like, "post").alias("like"),
        counts.count_value(F.col("view_label"), "post").alias("view"),
        tx.handle_from_url(F.col("author_url")).alias("author_id"),
    )
