"""Registration of the queries of this subpackage, and column helpers its operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The characters that separate words, as the inside of a regular expression class.
SPACE = r"\x20\x09-\x0D"


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the DuckDB text that gives the same rows."""

    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, columns: Iterable[str]) -> str:
    """``name``, or the next one no column has: Spark takes names that differ in case for one."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, outlives executors.

    Spark drops the shuffle files of a finished job once the driver has collected its plan, which
    a driver with memory to spare puts off; so it is asked to.
    """
    spark = df.sparkSession
    path = session.run_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out
