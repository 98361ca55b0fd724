"""Session and shared-folder helpers. Only entry points (bench, tests) build a session."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trendloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TRENDLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder: on a cluster such a folder
    would be invisible to the other machines and lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_fallback()


_fallback: list[str] = []


def _local_fallback() -> str:
    if not _fallback:
        _fallback.append(tempfile.mkdtemp(prefix="trendloom-"))
    return _fallback[0]


def is_missing(error: AnalysisException) -> bool:
    """True when nothing lies at the path that was to be read; any other error is one."""
    return error.getCondition() == "PATH_NOT_FOUND"


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a cached block."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager)


def drop(spark: SparkSession, path: str | None) -> None:
    """Delete a folder of ``run_dir`` that is read no more."""
    if path:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of tables that nobody holds any more. It does so once the
    driver has collected its garbage, which a driver with memory to spare puts off."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
