"""Author metrics that arrive over time, kept as a log of newest counts per batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendloom import schemas, session
from trendloom.operators import enrich


def newest_per_author(metrics: DataFrame) -> DataFrame:
    """One row per author: the newest known count."""
    newest = F.max(F.struct("crawled_at", "follower_count"))
    return (
        metrics.filter(F.col("follower_count") != enrich.PENDING)
        .groupBy("author_id")
        .agg(newest.alias("m"))
        .select("author_id", "m.follower_count", "m.crawled_at")
    )


def stream_metrics(metrics: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Reduce each batch to the newest count per author and write it to a folder of its own.

    A batch that runs again after a failure overwrites its own folder, so no count is taken
    twice, and the posts are not rewritten for every batch.
    """

    def save(batch: DataFrame, number: int) -> None:
        newest_per_author(batch).write.mode("overwrite").parquet(f"{log}/batch={number}")

    return (
        metrics.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_metrics(spark: SparkSession, log: str) -> DataFrame:
    """The newest count per author over all batches."""
    try:
        batches = spark.read.schema(schemas.AUTHOR_METRICS).parquet(f"{log}/batch=*")
    except AnalysisException as error:
        if not session.is_missing(error):
            raise
        return spark.createDataFrame([], schemas.AUTHOR_METRICS)
    return newest_per_author(batches)


def compact(spark: SparkSession, log: str, out: str) -> None:
    """Write the log as one table, to start a new log from."""
    read_metrics(spark, log).write.mode("overwrite").parquet(f"{out}/batch=0")
