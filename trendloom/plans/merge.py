"""Dumps to one table without repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from trendloom import schemas
from trendloom.operators import dedup
from trendloom.sources import dumps


def merge_posts(frames: Sequence[DataFrame], order: Sequence[str], key: str = "text") -> DataFrame:
    """All rows of all frames, first row per text; whole rows when there is no text column."""
    merged = dedup.union_by_name(frames)
    if key not in merged.columns:
        return dedup.dedup_rows(merged.drop(*order))
    return dedup.dedup_first(merged, [key], order)


def merge_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames without full repeats."""
    return dedup.dedup_rows(dedup.union_by_name(frames))


def merge_post_dumps(spark: SparkSession, path: str, na_values: Sequence[str] = ()) -> DataFrame:
    """The post dumps of a folder; a text counts where its file and row come first."""
    rows = dumps.good_rows(dumps.read_dumps(spark, path, schemas.POSTS, na_values=na_values))
    first = merge_posts([rows], [dumps.FILE, dumps.ROW])
    return first.select(schemas.POSTS.fieldNames())


def merge_video_dumps(spark: SparkSession, path: str, na_values: Sequence[str] = ()) -> DataFrame:
    rows = dumps.good_rows(dumps.read_dumps(spark, path, schemas.VIDEO_ROWS, na_values=na_values))
    return merge_rows([rows.select(schemas.VIDEO_ROWS.fieldNames())])
