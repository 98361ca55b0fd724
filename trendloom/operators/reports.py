"""Per-step reports. Counts of one report come from one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import session
from trendloom.functions import text as tx
from trendloom.operators import quantiles


def step_counts(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """(step_no, step, before, removed, after, pct_kept) for filters applied in a row.

    Each value of ``steps`` is the condition that keeps a row; null counts as removed.
    """
    passed, counts = F.lit(True), [F.count("*").alias("_c0")]
    for i, condition in enumerate(steps.values(), 1):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(f"_c{i}"))
    rows = [
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(f"_c{i - 1}").alias("before"),
            (F.col(f"_c{i - 1}") - F.col(f"_c{i}")).alias("removed"),
            F.col(f"_c{i}").alias("after"),
            tx.percent(F.col(f"_c{i}"), F.col("_c0")).alias("pct_kept"),
        )
        for i, name in enumerate(steps, 1)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def dedup_counts(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows before a dedup, removed by it, and after it; nulls equal each other."""
    per_key = df.groupBy(*_digests(df, subset)).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
        F.count("*").alias("after"),
    )


def _digests(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns for counting: whole texts are not shuffled only to be told apart."""
    kinds = dict(df.dtypes)
    return [(tx.digest(F.col(c)) if kinds[c] == "string" else F.col(c)).alias(c) for c in columns]


def date_range(df: DataFrame, column: str = "created_at") -> DataFrame:
    """First and last time; text that is not a date is left out."""
    times = tx.parse_created_at(F.col(column))
    return df.select(times.alias("t")).agg(F.min("t").alias("first_at"), F.max("t").alias("last_at"))


def unique_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.select(_digests(df, columns)).agg(*[count(c).alias(f"unique_{c}") for c in columns])


def non_null_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.col(column)).alias("present"))


def similarity_stats(
    scored: DataFrame,
    column: str = "tech_similarity",
    threshold: float | None = None,
    population: str = "kept",
) -> DataFrame:
    """(n, mean, median, lowest, highest) of the score.

    ``population`` is 'kept' for rows at or above the threshold, 'all' for all scored rows.
    """
    if population not in ("kept", "all"):
        raise ValueError(f"unknown population: {population}")
    if population == "kept" and threshold is not None:
        scored = scored.filter(F.col(column) >= threshold)
    scored = session.cut_lineage(scored.select(column))  # scored once, read for each figure
    median = quantiles.exact_median(scored, column).scalar()
    return scored.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.min(column).alias("lowest"),
        F.max(column).alias("highest"),
    ).select("n", "mean", median.alias("median"), "lowest", "highest")


def comments_per_video(rows: DataFrame, title: str = "video_title") -> DataFrame:
    """Rows per accepted title; null on no titles."""
    return rows.agg(
        F.count("*").alias("rows"), F.count_distinct(F.col(title)).alias("videos")
    ).withColumn("rows_per_video", F.try_divide("rows", "videos"))


def extremes(
    scored: DataFrame,
    column: str,
    tie: str,
    n: int = 5,
    show: str | None = None,
    width: int = 80,
) -> DataFrame:
    """The n highest and n lowest rows, with a preview of the text; no full sort."""
    columns = [F.col(tie), F.col(column)]
    if show:
        columns.append(tx.preview(F.col(show), width).alias("preview"))

    def end(name: str, order: Column) -> DataFrame:
        top = scored.orderBy(order, F.col(tie)).limit(n)
        return top.select(F.lit(name).alias("side"), *columns)

    scored = scored.filter(F.col(column).isNotNull())
    return end("top", F.col(column).desc()).unionByName(end("bottom", F.col(column).asc()))


def head_docs(df: DataFrame, order: str, n: int = 2000) -> DataFrame:
    return df.orderBy(order).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """A random n rows that is the same on every run: lowest md5 of seed and key."""
    digest = F.md5(F.concat(F.lit(seed), F.lit(":"), F.col(key).cast("string")))
    return df.orderBy(digest, F.col(key)).limit(n)


def best_k(scores: DataFrame, k: str = "k", score: str = "score") -> DataFrame:
    """The candidate with the best score; the smaller one on a tie."""
    best = F.max(F.struct(F.col(score).alias("score"), (-F.col(k)).alias("k")))
    return scores.agg(best.alias("best")).select((-F.col("best.k")).alias("k"), F.col("best.score").alias("score"))


def cluster_sizes(df: DataFrame, column: str = "topic_id") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("doc_count"))


def topic_size_stats(df: DataFrame, column: str = "topic_id", noise: int = -1) -> DataFrame:
    """Number of topics, noise rows and share, and sizes of the topics."""
    sizes = cluster_sizes(df, column)
    is_topic = F.col(column) != noise
    size = F.when(is_topic, F.col("doc_count"))
    return sizes.agg(
        F.coalesce(F.sum("doc_count"), F.lit(0)).alias("docs"),
        F.count(size).alias("topics"),
        F.coalesce(F.sum(F.when(~is_topic, F.col("doc_count"))), F.lit(0)).alias("noise_docs"),
        F.avg(size).alias("mean_size"),
        F.max(size).alias("max_size"),
        F.min(size).alias("min_size"),
    ).withColumn("noise_pct", tx.percent(F.col("noise_docs"), F.col("docs")))
