"""Result tables: whole folders, appended batches, and versions of an enriched table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import session


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write a result folder, one file per task. CSV parts start with a byte order mark."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        marked = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
        marked.write.mode("overwrite").options(header=True, escape='"').csv(path)
    else:
        writer.format(fmt).save(path)


def append_dump(df: DataFrame, path: str, crawl_date: str) -> None:
    """Add a batch under its date; earlier files stay untouched."""
    dated = df.withColumn("crawl_date", F.to_date(F.lit(crawl_date)))
    dated.write.mode("append").partitionBy("crawl_date").parquet(path)


def save_version(df: DataFrame, path: str) -> int:
    """Write the next version of a table next to the earlier ones.

    A run that dies leaves the last complete version in place, and a table may be read
    while its successor is written.
    """
    spark = df.sparkSession
    version = (latest_version(spark, path) or 0) + 1
    df.drop("author_id_clean").write.mode("overwrite").parquet(f"{path}/version={version}")
    done = spark.range(1).select(F.lit(version).alias("done"))
    done.write.mode("append").parquet(f"{path}/finished")
    return version


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The highest version whose write was finished."""
    try:
        return spark.read.schema("done int").parquet(f"{path}/finished").agg(F.max("done")).first()[0]
    except AnalysisException as error:
        if not session.is_missing(error):
            raise
        return None


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version or latest_version(spark, path)}")
