"""Registration of queries, each next to the SQL that must give the same rows.

The queries run over the given tables, which stand in for crawled data: documents for posts
and headlines (doc_id is the order of arrival, source the search query), conversations for
video rows, pages for crawled pages, embeddings for text vectors, events for authors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name; ``sql`` is the DuckDB text to compare with."""

    def add(run):
        REGISTRY[name or run.__name__] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table. ``spread`` asks for a task per core where the work on a row is heavy.

    That deals out the rows of a table with fewer splits than cores. A large table has more
    splits than the cluster has cores and is read as it lies, without a shuffle.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if spread and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


# A word list as a user would give it; one word has capitals, one a blank.
EXCLUDED = ("idiot", "worthless", "Pathetic", "disgusting", "the casino")
THEMES = {
    "insults": ("idiot", "worthless", "Pathetic", "disgusting"),
    "gambling": ("casino", "bets"),
    "spam": ("click here", "free", "buy now"),
}
EXCLUDED_SQL = " OR ".join(f"contains(lower(text), '{w.lower()}')" for w in EXCLUDED)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", spread=True).select(
        F.col("doc_id").alias("seq"), F.col("source").alias("search_query"), "text"
    )


def video_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as video rows: the system turn is the description."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("/watch?v="), F.col("conv_id").cast("string")).alias("video_url"),
        F.col("conv_id"),
        F.col("turn").alias("seq"),
        F.col("role").alias("author"),
        F.col("text").alias("comment"),
        F.when(F.col("role") == "system", "description").otherwise("comment").alias("type"),
    )


VIDEO_ROWS_SQL = """
    SELECT concat('/watch?v=', CAST(conv_id AS VARCHAR)) AS video_url, conv_id, turn AS seq,
           role AS author, text AS comment,
           CASE WHEN role = 'system' THEN 'description' ELSE 'comment' END AS type
    FROM conversations"""
