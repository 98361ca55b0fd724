"""An exact median in two reads, which never gathers the values in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trendloom import session

ACCURACY = 20_000


def exact_median(df: DataFrame, column: str, accuracy: int = ACCURACY) -> DataFrame:
    """One row (median): the middle value, or the mean of the two middle values; null on no values.

    The first read counts the values and, by a sketch whose ranks are off by 1 / ``accuracy`` at
    most, brackets the middle. The second counts what lies below the bracket and, value by value,
    what lies in it, so that the counts prove the bracket; if it does not hold the middle, all values
    take its place. The bracket, a few values in ``accuracy``, is sorted in ranges; the driver sees a
    row per range. Pass a table that was written or checkpointed, not a long plan.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    margin = 2 / accuracy
    ends = F.percentile_approx("v", [0.5 - margin, 0.5 + margin], accuracy)
    n, bracket = values.agg(F.count("v"), ends).first()
    if not n:
        return spark.createDataFrame([(None,)], "median double")
    ranks = sorted({(n + 1) // 2, (n + 2) // 2})
    counted, below = _counted(values, *bracket)
    inside = counted.agg(F.sum("n")).first()[0] or 0
    if not below < ranks[0] <= ranks[-1] <= below + inside:
        counted, below = _counted(values, None, None)
    found = _at(counted, [r - below for r in ranks])
    return spark.createDataFrame([(sum(found) / len(found),)], "median double")


def _counted(values: DataFrame, low: float | None, high: float | None) -> tuple[DataFrame, int]:
    """(v, n) of the values from ``low`` to ``high``, and how many lie below."""
    if low is None:
        marked = values.select(F.lit(0).alias("side"), "v")
    else:
        side = F.when(F.col("v") < low, -1).when(F.col("v") > high, 1).otherwise(0)
        marked = values.select(side.alias("side"), F.when(side == 0, F.col("v")).alias("v"))
    counts = _stored(marked.groupBy("side", "v").agg(F.count("*").alias("n")), "bracket")
    below = counts.filter("side = -1").agg(F.sum("n")).first()[0] or 0
    return counts.filter("side = 0").select("v", "n"), below


def _at(counted: DataFrame, ranks: list[int]) -> list[float]:
    """The values of these ranks among values that come ``n`` times each."""
    ranged = _stored(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # a row per range
    out = []
    for rank in ranks:
        for row in sizes:
            if rank <= row["n"]:
                upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
                own = ranged.filter(F.col("part") == row["part"]).withColumn("upto", F.sum("n").over(upto))
                out.append(own.filter(F.col("upto") >= rank).agg(F.min("v")).first()[0])
                break
            rank -= row["n"]
    return out


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = session.run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
