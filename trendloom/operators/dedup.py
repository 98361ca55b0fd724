"""Union and removal of duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Outer set of columns; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_first(
    df: DataFrame, subset: Sequence[str | Column] | None, order: Sequence[str | Column]
) -> DataFrame:
    """The first row per value of ``subset`` in the given order; nulls equal each other.

    The window is led by a 64-bit hash of the key: sorting then compares numbers and looks
    at the long text only on a tie. Spark keeps one row per key in every input partition
    before the shuffle, so a text that fills a third of the table costs one row per task.
    """
    if not subset:
        return dedup_rows(df)
    # A named column is used as it is; only computed keys become columns of their own.
    made = {f"_key{i}": c for i, c in enumerate(subset) if not isinstance(c, str)}
    keys = [c if isinstance(c, str) else f"_key{i}" for i, c in enumerate(subset)]
    keyed = df.withColumns(made).withColumn("_hash", F.xxhash64(*keys))
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    return (
        keyed.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank", "_hash", *made)
    )


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_prefix(df: DataFrame, column: str, per: str, order: Sequence[str], n: int = 50) -> DataFrame:
    """The first row per n-character beginning of the text, inside each value of ``per``."""
    return dedup_first(df, [per, F.substring(column, 1, n)], order)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Unique values that are neither null nor empty."""
    return df.select(column).filter(F.col(column).isNotNull() & (F.col(column) != "")).distinct()


def keyword_union(df: DataFrame, column: str = "keyword") -> DataFrame:
    """Words of all topics without repeats."""
    return distinct_values(df, column).select(F.col(column).alias("keyword"))
