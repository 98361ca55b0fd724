"""Joins and rankings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 256
# Keys that are salted: so many at most, and only such with so many rows.
HOT_KEYS = 1000
HOT_ROWS = 100_000


def salt_of(columns: Sequence[str | Column], salts: int = SALTS) -> Column:
    """A salt from the row's content, so that a task that runs again deals the same salts."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def first_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str | None = None,
    groups: int = 1024,
) -> DataFrame:
    """The first ``n`` rows of each key, optionally with their rank.

    Every input task keeps its own first n rows of a key before the shuffle. Those of a hot
    key, which all tasks hold, first meet in up to ``groups`` groups of tasks and only then
    in one place, so no task sees more than n rows per group or per task of a group.
    """
    keys = list(keys)
    grouped = df.withColumn("_group", F.spark_partition_id() % groups)
    part = Window.partitionBy(*keys, "_group").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "_rank"
    out = (
        grouped.withColumn("_rank0", F.row_number().over(part))
        .filter(F.col("_rank0") <= n)
        .drop("_rank0", "_group")
        .withColumn(name, F.row_number().over(whole))
        .filter(F.col(name) <= n)
    )
    return out if rank else out.drop(name)


def hot_keys(df: DataFrame, key: str, limit: int = HOT_KEYS, min_rows: int = HOT_ROWS) -> DataFrame:
    """(key): the ``limit`` most frequent values, as far as they hold ``min_rows`` rows.

    Frequent-items sketches find them in one pass: one per task, merged in groups of tasks,
    whose short lists are then added up. The counts are estimates. That decides how rows
    are dealt out later and never what the result is.
    """
    per_group = df.groupBy((F.spark_partition_id() % 256).alias("_group")).agg(
        F.expr(f"approx_top_k(`{key}`, {limit}, {10 * limit})").alias("top")
    )
    return (
        per_group.select(F.inline("top"))
        .groupBy(F.col("item").alias(key))
        .agg(F.sum("count").alias("n"))
        .filter(F.col("n") >= min_rows)
        .orderBy(F.desc("n"), key)
        .limit(limit)
        .select(key)
    )


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str | Column],
    how: str = "left",
    salts: int = SALTS,
    max_rows: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join facts to a table with one row per key, however unevenly facts use the keys.

    Facts of hot keys are dealt over ``salts`` salts and the dim rows of those keys, a
    thousand at most, are repeated once per salt; all other rows are joined as they are.
    ``salt_by`` names columns that tell facts apart. With ``max_rows`` the dim side, which
    should be a written table then, is counted first and broadcast up to that many rows.
    """
    if max_rows is not None and dim.limit(max_rows + 1).count() <= max_rows:
        return facts.join(F.broadcast(dim), list(on), how)
    keyed = facts.withColumn("_key", F.xxhash64(*on))
    hot = hot_keys(keyed, "_key", min_rows=hot_rows).withColumn("_hot", F.lit(True))
    hot = F.broadcast(hot)  # HOT_KEYS rows at most
    dealt = keyed.join(hot, "_key", "left").withColumn(
        "_salt", F.when(F.col("_hot"), salt_of(list(salt_by), salts)).otherwise(0)
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    repeated = (
        dim.withColumn("_key", F.xxhash64(*on))
        .join(hot, "_key", "left")
        .withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0)))))
        .drop("_key", "_hot")
    )
    kept = [] if how in ("left_semi", "left_anti") else [c for c in dim.columns if c not in on]
    joined = dealt.drop("_key", "_hot").join(repeated, [*on, "_salt"], how)
    return joined.select(*facts.columns, *kept)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark a table for broadcast only when it was counted to be small; narrow rows assumed."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def dense_index(df: DataFrame, key: str, seed: str = "", name: str = "idx") -> DataFrame:
    """0, 1, 2 ... over the rows in the order of md5(seed + key), without a global sort.

    Rows are numbered inside 4,096 ranges of the hash; the start of each range comes from
    one small count table, the only part that a single task sees. ``key`` must be unique.
    """
    hashed = df.withColumn("_md5", F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))).withColumn(
        "_range", F.substring("_md5", 1, 3)
    )
    running = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_range").orderBy("_md5", key)
    return (
        hashed.withColumn("_pos", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), "_range")
        .withColumn(name, (F.col("_start") + F.col("_pos")).cast("bigint"))
        .drop("_md5", "_range", "_pos", "_start")
    )
