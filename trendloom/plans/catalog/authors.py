"""Author enrichment, in batch and as a stream, over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendloom import session
from trendloom.operators import enrich
from trendloom.plans import enrichment
from trendloom.plans.catalog.base import query, table
from trendloom.sources import snapshots
from trendloom.streaming import enrich as enrich_stream_jobs
from trendloom.streaming import merge as merge_stream_jobs

# Events as posts: every user writes, some rows still wait for a count, some have none at all.
_POSTS = """SELECT event_id AS seq, concat('@u', CAST(user_id AS STRING), CASE WHEN event_id % 3 = 0
    THEN ' ' ELSE '' END) AS author_id, CASE WHEN user_id % 5 = 0 THEN CAST(user_id AS BIGINT)
    WHEN event_id % 4 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS follower_count
    FROM events"""
# The sign-ups of some users as metrics; a metric may itself be unknown.
_METRICS = """SELECT concat('u', CAST(user_id AS STRING)) AS author_id,
    CASE WHEN event_id % 7 = 0 THEN CAST(-1 AS BIGINT) ELSE CAST(floor(value * 100) AS BIGINT) END
    AS follower_count, ts AS crawled_at FROM events
    WHERE event_type = 'signup' AND user_id % 3 <> 0"""
_NEWEST_SQL = f"""SELECT author_id AS author, follower_count AS new_count FROM (
    SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY crawled_at DESC, follower_count DESC)
      AS rn FROM ({_METRICS}) WHERE follower_count <> -1) WHERE rn = 1"""
_ENRICHED_SQL = f"""SELECT seq, author_id, coalesce(new_count, follower_count, -1) AS follower_count
    FROM ({_POSTS}) LEFT JOIN ({_NEWEST_SQL}) ON author = trim(replace(author_id, '@', ''))"""


def _posts(spark, sf_dir):
    return _select(spark, sf_dir, _POSTS)


def _metrics(spark, sf_dir):
    return _select(spark, sf_dir, _METRICS)


def _select(spark, sf_dir, sql):
    return spark.sql(sql.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))


@query(
    f"""SELECT DISTINCT trim(replace(author_id, '@', '')) AS author FROM ({_POSTS})
    WHERE coalesce(follower_count, -1) = -1"""
)
def pending_authors(spark, sf_dir):
    return enrich.pending_authors(_posts(spark, sf_dir))


@query(
    f"""SELECT DISTINCT trim(replace(author_id, '@', '')) AS author FROM ({_POSTS})
    WHERE coalesce(follower_count, -1) = -1
      AND trim(replace(author_id, '@', '')) NOT IN (SELECT author FROM ({_NEWEST_SQL}))"""
)
def pending_anti(spark, sf_dir):
    return enrich.pending_authors(_posts(spark, sf_dir), _metrics(spark, sf_dir))


@query(_ENRICHED_SQL)
def enrich_authors(spark, sf_dir):
    return enrich.enrich_authors(_posts(spark, sf_dir), _metrics(spark, sf_dir), ["seq"])


@query(
    f"""WITH a AS (SELECT trim(replace(author_id, '@', '')) AS author,
        max(CASE WHEN follower_count = -1 THEN 1 ELSE 0 END) AS p FROM ({_ENRICHED_SQL}) GROUP BY 1)
    SELECT count(*) AS users, count(*) FILTER (WHERE p = 1) AS pending,
      count(*) FILTER (WHERE p = 0) AS done FROM a"""
)
def progress(spark, sf_dir):
    return enrich.progress(enrich_authors(spark, sf_dir))


@query("SELECT DISTINCT concat(event_type, ' ', CAST(user_id AS VARCHAR)) AS text FROM events")
def stream_merge(spark, sf_dir):
    """The merge as a stream."""
    run = session.run_dir(spark, "stream-merge")
    schema = table(spark, sf_dir, "events").schema
    arriving = merge_stream_jobs.read_stream(spark, sf_dir, schema, glob="events.parquet").select(
        F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("text"),
        F.col("ts").alias("created_at"),
    )
    merge_stream_jobs.stream_merge(arriving, f"{run}/rows", f"{run}/state").awaitTermination()
    return spark.read.parquet(f"{run}/rows").select("text")


@query(_ENRICHED_SQL)
def stream_enrich(spark, sf_dir):
    """The enrichment with metrics taken from a stream of events."""
    run = session.run_dir(spark, "stream-enrich")
    schema = table(spark, sf_dir, "events").schema
    events = merge_stream_jobs.read_stream(spark, sf_dir, schema, glob="events.parquet")
    arriving = events.filter((F.col("event_type") == "signup") & (F.col("user_id") % 3 != 0)).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("author_id"),
        F.when(F.col("event_id") % 7 == 0, F.lit(-1))
        .otherwise(F.floor(F.col("value") * 100))
        .cast("bigint")
        .alias("follower_count"),
        F.col("ts").cast("timestamp").alias("crawled_at"),
    )
    enrich_stream_jobs.stream_metrics(arriving, f"{run}/log", f"{run}/state").awaitTermination()
    metrics = enrich_stream_jobs.read_metrics(spark, f"{run}/log")
    return enrich.enrich_authors(_posts(spark, sf_dir), metrics, ["seq"])


@query(
    f"""WITH p AS (SELECT seq, author_id, follower_count, trim(replace(author_id, '@', '')) AS author FROM ({_POSTS})),
    asked AS (SELECT DISTINCT author FROM p WHERE coalesce(follower_count, -1) = -1 AND author <> '')
    SELECT seq, author_id, coalesce(new_count, follower_count, -1) AS follower_count
    FROM p LEFT JOIN (SELECT * FROM ({_NEWEST_SQL}) WHERE author IN (FROM asked)) n ON n.author = p.author"""
)
def enrich_snapshot(spark, sf_dir):
    """The enrichment as one job on a snapshot table: known counts stay, pending ones are written."""
    path = session.run_dir(spark, "enrich-snapshot")
    enrichment.start(_posts(spark, sf_dir), path, buckets=16)
    done = enrichment.apply_metrics(spark, path, _metrics(spark, sf_dir), ["seq"])
    return snapshots.read(spark, path, done)
