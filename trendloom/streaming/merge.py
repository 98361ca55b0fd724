"""Dumps that arrive over time, merged with repeated texts removed."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.options(header=True, multiLine=True, escape='"')
    return reader.load(path)


def stream_merge(
    rows: DataFrame, out: str, checkpoint: str, key: str = "text", event_time: str = "created_at"
) -> StreamingQuery:
    """Append the unseen rows of all files that are there; run again to go on.

    Dumps come in any order of dates, so nothing is dropped for being late: each batch keeps the
    first row per key by ``event_time`` (no or a bad time first, then the row's content) and leaves
    out keys that earlier batches wrote, however long ago. Null keys count as one. Rows go to
    ``out`` by batch number (column ``batch``, which the rows must not have).

    The keys seen are the state of a streaming ``dropDuplicates``, as hashes: a batch looks up its own
    keys there and reads no log of the others. The micro-batch is the union of its new keys and its
    rows, so one aggregation picks the first row of each new key. State lies in as many partitions as
    the session shuffles to when the stream first starts; many keys want the session's RocksDB state
    store. A batch that is run again starts from the state before it and replaces its own files, so a
    failure repeats nothing. Keys repeat at most once per Arrow batch of a task before they are
    shuffled, and rows are aggregated in their tasks first.
    """
    if "batch" in rows.columns:
        raise ValueError("a column named batch would clash with the number of the batch")
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    order = F.struct(F.col(event_time).try_cast("timestamp").alias("time"), F.to_json(whole).alias("row"))
    parcels = rows.select(
        F.unhex(F.sha2(F.to_json(F.struct(key)), 256)).alias("_key"), order.alias("_order"), whole.alias("_row")
    )
    unseen = parcels.select("_key").mapInArrow(_different(), "_key binary").dropDuplicates(["_key"])
    both = parcels.withColumn("_new", F.lit(False)).unionByName(
        unseen.withColumn("_new", F.lit(True)), allowMissingColumns=True
    )

    def append(batch: DataFrame, number: int) -> None:
        # One action: a second one would look the keys up again.
        first = batch.groupBy("_key").agg(
            F.max("_new").alias("_new"), F.min_by(F.when(~F.col("_new"), F.col("_row")), "_order").alias("_row")
        )
        first.filter("_new").select("_row.*").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        both.writeStream.foreachBatch(append)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _different():
    def different(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pc.unique(batch.column(0))], names=["_key"])

    return different
