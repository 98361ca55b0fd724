"""Tables in committed snapshots: buckets of files, and one manifest per version.

A version names a folder for each bucket, so an update writes only the buckets it changes and
takes the other folders over. Files count from the moment their manifest is there; what a dead
writer left is read by nobody. The manifest of version n + 1 is moved into place and never over
another one, so of two writers that started from version n one commits and the other gets a
``Conflict``. This needs a shared file system whose rename does not replace files, like HDFS.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom import session

_BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer committed first; start again from the newest version."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: T.StructType
    key: str  # the SQL expression that rows are dealt by
    buckets: int
    folders: dict[int, str] = field(default_factory=dict)

    def bucket(self, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.expr(self.key) if key is None else key), F.lit(self.buckets)).cast("int")


def current(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest committed version, or the one asked for; None for a table without any."""
    name = f"{version:010d}.json" if version else "*.json"
    try:
        manifests = spark.read.format("binaryFile").option("pathGlobFilter", name).load(f"{path}/commits")
        newest = manifests.select("path").agg(F.max("path")).first()[0]
    except AnalysisException as error:
        if not session.is_missing(error):
            raise
        return None
    if newest is None:
        return None
    told = json.loads(spark.read.text(newest, wholetext=True).first()[0])
    return Snapshot(
        told["version"], T.StructType.fromJson(told["schema"]), told["key"], told["buckets"],
        {int(b): f for b, f in told["folders"].items()},
    )


def read(spark: SparkSession, path: str, snapshot: Snapshot, only: Iterable[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets. Columns it knows and files lack are null."""
    wanted = snapshot.folders if only is None else [b for b in only if b in snapshot.folders]
    folders = [f"{path}/{snapshot.folders[b]}" for b in wanted]
    if not folders:
        return spark.createDataFrame([], snapshot.schema)
    return spark.read.schema(snapshot.schema).parquet(*folders)


def create(df: DataFrame, path: str, key: str, buckets: int = 256) -> Snapshot:
    """The first version of a table whose rows are dealt by the SQL expression ``key``."""
    return _commit(df.sparkSession, path, _written(df, path, Snapshot(1, df.schema, key, buckets)))


def replace(df: DataFrame, path: str, base: Snapshot, changed: Iterable[int]) -> Snapshot:
    """The version after ``base``: ``df`` holds all rows of the ``changed`` buckets, which may become
    empty and must not be too few; all other buckets stay as they lie."""
    kept = {b: f for b, f in base.folders.items() if b not in set(changed)}
    made = _written(df, path, Snapshot(base.version + 1, df.schema, base.key, base.buckets))
    stray = set(made.folders) - set(changed)
    if stray:
        raise ValueError(f"rows of buckets that were not to change: {sorted(stray)[:10]}")
    return _commit(df.sparkSession, path, Snapshot(made.version, made.schema, made.key, made.buckets, kept | made.folders))


def _written(df: DataFrame, path: str, plan: Snapshot) -> Snapshot:
    if _BUCKET in df.columns:
        raise ValueError(f"a column named {_BUCKET} would clash with the bucket number")
    folder = f"data/{uuid.uuid4().hex}"
    # Rebalanced by bucket: small ones share a task, one that holds a hot key is split.
    dealt = df.withColumn(_BUCKET, plan.bucket()).hint("rebalance", _BUCKET)
    dealt.write.partitionBy(_BUCKET).parquet(f"{path}/{folder}")
    files, target = _files(df.sparkSession, f"{path}/{folder}")
    names = [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]
    found = {int(n.split("=")[1]): f"{folder}/{n}" for n in names if n.startswith(f"{_BUCKET}=")}
    return Snapshot(plan.version, plan.schema, plan.key, plan.buckets, found)


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def _commit(spark: SparkSession, path: str, made: Snapshot) -> Snapshot:
    told = {
        "version": made.version, "schema": made.schema.jsonValue(), "key": made.key,
        "buckets": made.buckets, "folders": made.folders,
    }
    fs, draft = _files(spark, f"{path}/drafts/{uuid.uuid4().hex}")
    _, target = _files(spark, f"{path}/commits/{made.version:010d}.json")
    fs.mkdirs(target.getParent())
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(told).encode()))
    finally:
        stream.close()
    options = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri(), fs.getConf()
    )
    plain = spark.sparkContext._gateway.new_array(options, 1)
    plain[0] = options.NONE
    if fs.exists(target):
        raise Conflict(f"version {made.version} is there already")
    try:
        context.rename(draft, target, plain)
    except Exception as failed:
        if fs.exists(target):
            raise Conflict(f"version {made.version} is there already") from failed
        raise
    return made
