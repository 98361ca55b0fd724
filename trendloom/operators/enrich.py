"""Follower counts: which authors still need one, and writing new counts back to the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions import text as tx
from trendloom.operators import skew

# Fixed value: the mark of a count that was not fetched yet. A page without a count is 0.
PENDING = -1


def with_follower_count(df: DataFrame) -> DataFrame:
    """Add the column, all pending, when the table has none yet."""
    if "follower_count" in df.columns:
        return df
    return df.withColumn("follower_count", F.lit(PENDING).cast("bigint"))


def _is_pending(count: Column) -> Column:
    return F.coalesce(count, F.lit(PENDING)) == PENDING


def pending_authors(posts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Distinct handles without a count. Authors in ``known`` metrics are not asked again."""
    asked = (
        with_follower_count(posts)
        .filter(_is_pending(F.col("follower_count")))
        .select(tx.clean_handle(F.col("author_id")).alias("author"))
        .filter(F.col("author") != "")
        .distinct()
    )
    if known is None:
        return asked
    done = known.filter(~_is_pending(F.col("follower_count"))).select(
        tx.clean_handle(F.col("author_id")).alias("author")
    )
    return asked.join(done, "author", "left_anti")


def newest_metrics(metrics: DataFrame) -> DataFrame:
    """(author, new_count): the newest known count of each author."""
    newest = F.max(F.struct("crawled_at", "follower_count"))
    return (
        metrics.filter(~_is_pending(F.col("follower_count")))
        .groupBy(tx.clean_handle(F.col("author_id")).alias("author"))
        .agg(newest["follower_count"].alias("new_count"))
        .filter(F.col("author") != "")
    )


def enrich_authors(
    posts: DataFrame, metrics: DataFrame, salt_by: Sequence[str] | None = None
) -> DataFrame:
    """Set follower_count on every row of an author that has a new count.

    ``salt_by`` names columns that tell rows apart; all columns by default.
    """
    base = with_follower_count(posts)
    keyed = base.withColumn("author", tx.clean_handle(F.col("author_id")))
    joined = skew.lookup(
        keyed, newest_metrics(metrics), ["author"], list(salt_by or base.columns), "left"
    )
    return joined.select(
        *[c for c in base.columns if c != "follower_count"],
        F.coalesce("new_count", "follower_count", F.lit(PENDING))
        .cast("bigint")
        .alias("follower_count"),
    )


def progress(posts: DataFrame) -> DataFrame:
    """Authors in all, still pending, and done. One pending row makes an author pending."""
    per_author = (
        with_follower_count(posts)
        .groupBy(tx.clean_handle(F.col("author_id")).alias("author"))
        .agg(F.max(_is_pending(F.col("follower_count"))).alias("pending"))
        .filter(F.col("author") != "")
    )
    return per_author.agg(
        F.count("*").alias("users"),
        F.count_if("pending").alias("pending"),
        F.count_if(~F.col("pending")).alias("done"),
    )
