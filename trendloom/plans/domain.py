"""Keep what belongs to a subject: word list first, then similarity to reference vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.functions import text as tx
from trendloom.operators import filters, reports, skew, vectors

# The thresholds in force.
POST_THRESHOLD = 0.5
VIDEO_THRESHOLD = 0.42


def reference_vectors(
    references: DataFrame | np.ndarray | Sequence[str],
    spark: SparkSession,
    vector: str = "embedding",
    encode: Callable[[Column], Column] | None = None,
) -> DataFrame | np.ndarray:
    """References as vectors: sentences, in a list or in the column ``text`` of a table without
    vectors, go through the encoder that the posts go through."""
    if isinstance(references, np.ndarray):
        return references
    if not isinstance(references, DataFrame):
        references = spark.createDataFrame([(t,) for t in references], "text string")
    if vector in references.columns:
        return references
    if encode is None:
        raise ValueError("sentences need an encoder, the one of the texts they are compared with")
    return references.select(encode(F.col("text")).alias(vector))


def score_posts(
    posts: DataFrame,
    references: DataFrame | np.ndarray | Sequence[str],
    words: Sequence[str],
    column: str = "text",
    vector: str = "embedding",
    encode: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Posts without excluded words, with their highest similarity to any reference.

    The word test runs first, so no vector is made for a post that it drops. References may be
    sentences, see ``reference_vectors``.
    """
    references = reference_vectors(references, posts.sparkSession, vector, encode)
    clean = filters.drop_excluded(posts, column, words)
    if vector not in clean.columns:
        clean = vectors.embed(clean, column, encode, vector)
    return vectors.max_similarity(clean, references, vector)


def domain_filter_posts(
    posts: DataFrame,
    references: DataFrame | np.ndarray | Sequence[str],
    words: Sequence[str],
    threshold: float = POST_THRESHOLD,
    **options,
) -> DataFrame:
    return filters.min_similarity(score_posts(posts, references, words, **options), threshold)


def post_report(
    posts: DataFrame,
    references: DataFrame | np.ndarray | Sequence[str],
    words: Sequence[str],
    threshold: float = POST_THRESHOLD,
    column: str = "text",
    vector: str = "embedding",
    encode: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Rows before, removed and after the word step and the similarity step, in one pass.

    Excluded posts reach the scoring without a vector, so nothing is computed for them.
    """
    references = reference_vectors(references, posts.sparkSession, vector, encode)
    given = posts.withColumn("_clean", ~filters.has_excluded(F.col(column), words))
    if vector in posts.columns:
        own = F.when(F.col("_clean"), F.col(vector))
    elif encode is not None:
        own = encode(F.when(F.col("_clean"), F.col(column)))
    else:
        raise ValueError(f"no column '{vector}' and no encoder")
    marked = given.select("_clean", own.alias(vector))
    scored = vectors.max_similarity(marked, references, vector, "_score")
    steps = {"words": F.col("_clean"), "similarity": F.col("_score") >= threshold}
    return reports.step_counts(scored, steps)


def video_report(
    rows: DataFrame,
    references: DataFrame,
    words: Sequence[str],
    threshold: float = VIDEO_THRESHOLD,
    titles: DataFrame | None = None,
    **options,
) -> DataFrame:
    """(titles, clean_titles, videos, rows, rows_per_video, pct_kept) of the video filter.

    Rows are counted per title before they meet the scores, so the join sees titles only.
    """
    per_title = rows.groupBy("video_title").agg(F.count("*").alias("rows"))
    scores = score_titles(rows if titles is None else titles, references, words, **options)
    met = per_title.join(scores.withColumn("_clean", F.lit(True)), "video_title", "left")
    passed = F.coalesce(F.col("tech_similarity") >= threshold, F.lit(False))
    counted = met.agg(
        F.count("*").alias("titles"),
        F.count_if("_clean").alias("clean_titles"),
        F.count_if(passed).alias("videos"),
        F.coalesce(F.sum(F.when(passed, F.col("rows"))), F.lit(0)).alias("rows"),
    )
    return counted.withColumns(
        {
            "rows_per_video": F.try_divide("rows", "videos"),
            "pct_kept": tx.percent(F.col("videos"), F.col("titles")),
        }
    )


def score_titles(
    titles: DataFrame,
    references: DataFrame,
    words: Sequence[str],
    vector: str = "embedding",
    encode: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(video_title, tech_similarity): one row per distinct title without excluded words.

    Similarity is taken to the mean of the references.
    """
    references = reference_vectors(references, titles.sparkSession, vector, encode)
    distinct = titles.select("video_title").distinct()
    if vector in titles.columns:  # of several vectors of a title the least
        distinct = titles.groupBy("video_title").agg(F.min(vector).alias(vector))
    clean = filters.drop_excluded(distinct, "video_title", words)
    if vector not in clean.columns:
        clean = vectors.embed(clean, "video_title", encode, vector)
    scored = vectors.centroid_similarity(clean, references, vector)
    return scored.select("video_title", "tech_similarity")


def domain_filter_videos(
    rows: DataFrame,
    references: DataFrame,
    words: Sequence[str],
    threshold: float = VIDEO_THRESHOLD,
    titles: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """All rows of the videos whose title passes, each with the title's similarity.

    Titles are scored once each. One join both keeps the rows and attaches the score; a
    video with a third of all comments is spread over the salts.
    """
    scores = score_titles(rows if titles is None else titles, references, words, **options)
    accepted = filters.min_similarity(scores, threshold)
    return skew.lookup(rows, accepted, ["video_title"], list(salt_by or rows.columns), "inner")


def keep_related(rows: DataFrame, accepted: DataFrame, key: str = "video_title") -> DataFrame:
    """All rows whose key is in the accepted set."""
    return skew.lookup(rows, accepted.select(key).distinct(), [key], rows.columns, "left_semi")


def attach_score(
    rows: DataFrame, scores: DataFrame, key: str = "video_title", score: str = "tech_similarity"
) -> DataFrame:
    """Bring the score of a key back to each of its rows; null where there is none."""
    best = scores.groupBy(key).agg(F.max(score).alias(score))
    return skew.lookup(rows, best, [key], rows.columns, "left")
