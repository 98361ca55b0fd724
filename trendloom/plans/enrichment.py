"""Follower counts written into a snapshot table: newest version, pending authors, join, commit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom import session
from trendloom.operators import enrich
from trendloom.sources import dumps, snapshots

# Rows of one author share a bucket: ``clean_handle`` of the author as an expression of SQL.
_KEY = r"regexp_replace(replace(author_id, '@', ''), r'^\s+|\s+$', '')"


def start(posts: DataFrame, path: str, buckets: int = 256) -> snapshots.Snapshot:
    """The first version: counts that are not there yet are pending."""
    counted = enrich.with_follower_count(posts).drop("author_id_clean")
    count = F.coalesce("follower_count", F.lit(enrich.PENDING)).cast("bigint")
    return snapshots.create(counted.withColumn("follower_count", count), path, _KEY, buckets)


def start_from_newest(
    spark: SparkSession, folder: str, path: str, schema: T.StructType, globs: Sequence[str], buckets: int = 256
) -> snapshots.Snapshot:
    """The first version, from the newest dump of the first pattern that matches a file."""
    newest = dumps.good_rows(dumps.latest_snapshot(spark, folder, schema, globs))
    return start(newest.select(schema.fieldNames()), path, buckets)


def pending(spark: SparkSession, path: str) -> DataFrame:
    """(author): whose count the newest version lacks."""
    return enrich.pending_authors(_newest(spark, path)[1])


def apply_metrics(
    spark: SparkSession, path: str, metrics: DataFrame, salt_by: Sequence[str] | None = None, attempts: int = 5
) -> snapshots.Snapshot:
    """Write new counts of pending authors to all their rows and commit the next version.

    Counts that are known stay, whatever the metrics say. Only buckets with an author that gets a
    count are read again and rewritten; without one the version stays. A writer that lost to another
    one starts again from that one's version.
    """
    for attempt in range(attempts):
        base, posts = _newest(spark, path)
        asked = enrich.pending_authors(posts)
        found = enrich.newest_metrics(metrics).join(asked, "author", "left_semi")
        found = session.cut_lineage(found.withColumn("_bucket", base.bucket(F.col("author"))))
        changed = [r[0] for r in found.select("_bucket").distinct().collect()]  # buckets at most
        if not changed:
            return base
        counts = found.select(
            F.col("author").alias("author_id"),
            F.col("new_count").alias("follower_count"),
            F.lit(None).cast("timestamp").alias("crawled_at"),
        )
        rows = snapshots.read(spark, path, base, changed)
        done = enrich.enrich_authors(rows, counts, salt_by).select(base.schema.fieldNames())
        try:
            return snapshots.replace(done, path, base, changed)
        except snapshots.Conflict:
            if attempt == attempts - 1:
                raise
    raise ValueError("at least one attempt")


def _newest(spark: SparkSession, path: str) -> tuple[snapshots.Snapshot, DataFrame]:
    base = snapshots.current(spark, path)
    if base is None:
        raise ValueError(f"no committed version in {path}")
    return base, snapshots.read(spark, path, base)
