import glob
import os
from datetime import datetime

import pytest
from conftest import rows

from trendloom import schemas
from trendloom.operators import dedup, enrich
from trendloom.streaming import enrich as stream_enrich
from trendloom.streaming import merge as stream_merge


def test_merge_over_several_runs_equals_batch(spark, tmp_path):
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    first = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("a", "2024-01-02")], "text string, created_at string")
    second = spark.createDataFrame([("b", "2024-01-03"), ("c", "2024-01-03")], first.schema)
    for batch in (first, second):
        batch.write.mode("append").parquet(source)
        stream = stream_merge.read_stream(spark, source, first.schema, files_per_batch=1)
        stream_merge.stream_merge(stream, out, state).awaitTermination()
    got = rows(spark.read.parquet(out), "text")
    assert got == rows(dedup.dedup_first(first.union(second), ["text"], ["created_at"]), "text")


def test_late_dumps_lose_no_row_and_repeat_none(spark, tmp_path):
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    schema = "text string, created_at string"
    dumps = [
        [("a", "2024-03-01"), ("b", "2024-03-02"), (None, "2024-03-01")],
        [("old", "2023-01-01"), ("a", "2023-01-01"), (None, None)],
        [("b", "2024-06-01"), ("older", "bad date"), ("old", "2022-01-01")],
    ]
    for dump in dumps:
        spark.createDataFrame(dump, schema).write.mode("append").parquet(source)
        stream = stream_merge.read_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
        stream_merge.stream_merge(stream, out, state).awaitTermination()
    everything = spark.createDataFrame([r for d in dumps for r in d], schema)
    assert rows(spark.read.parquet(out), "text") == rows(dedup.dedup_first(everything, ["text"], ["created_at"]), "text")


def test_rows_keep_their_types_and_order(spark, tmp_path):
    """Whole numbers beyond 2^53, microseconds, lists, maps and gaps come out as they went in."""
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "text string, created_at timestamp, n long, x double, l array<string>, m map<string,int>, raw binary, _key int, _row string"
    at = datetime(2024, 5, 1, 10, 0, 0, 123456)
    data = [
        ("a", datetime(2024, 5, 2), 1, 0.5, None, None, None, 1, "late"),
        ("a", at, 2**60 + 1, float("nan"), ["x", None, ""], {"k": 1}, b"\x00\xff", 2, "early"),
        ("b", at, 2, 0.1, [], {}, b"", 3, "tie 2"),
        ("b", at, 1, 0.1, [], {}, b"", 3, "tie 1"),
        (None, None, None, None, None, None, None, None, None),
        ("", at, None, None, None, None, None, 4, "empty\n\u0000\ud7ff"),
    ]
    spark.createDataFrame(data, schema).repartition(3).write.parquet(source)
    stream = stream_merge.read_stream(spark, source, spark.read.parquet(source).schema)
    stream_merge.stream_merge(stream, out, f"{tmp_path}/state").awaitTermination()
    got = spark.read.parquet(out)
    kept = [data[i] for i in (1, 3, 4, 5)]
    plain = ["text", "created_at", "n", "l", "m", "raw", "_key", "_row"]
    expected = spark.createDataFrame(kept, schema)
    assert sorted(map(str, got.select(plain).collect())) == sorted(map(str, expected.select(plain).collect()))
    assert got.filter("isnan(x)").count() == 1


def test_state_holds_the_keys(spark, tmp_path):
    """A later batch learns of earlier keys from the state alone, and a batch run again repeats nothing."""
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    schema = "text string, created_at string"
    everything = []
    for day in range(4):
        dump = [(f"t{i}", f"2024-01-0{4 - day}") for i in range(day * 50, day * 50 + 100)] + [("hot", "2024-01-01")] * 500
        everything += dump
        spark.createDataFrame(dump, schema).write.mode("append").parquet(source)
        stream = stream_merge.read_stream(spark, source, spark.read.parquet(source).schema)
        query = stream_merge.stream_merge(stream, out, state)
        query.awaitTermination()
        if day == 2:  # the batch was written but not committed
            commit = max(glob.glob(f"{state}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
            os.remove(commit)
            for crc in glob.glob(f"{state}/commits/.{os.path.basename(commit)}.crc"):
                os.remove(crc)
    got = spark.read.parquet(out)
    assert rows(got, "text") == sorted({(t,) for t, _ in everything})
    operator = query.lastProgress.stateOperators[0]
    assert operator.numRowsTotal == got.count()
    assert rows(got.groupBy("batch").count(), "count") == [(50,), (50,), (50,), (101,)]
    with pytest.raises(ValueError):
        stream_merge.stream_merge(stream.selectExpr("*", "1 AS batch"), out, state)


def test_metrics_log(spark, tmp_path):
    source, log, state = f"{tmp_path}/in", f"{tmp_path}/log", f"{tmp_path}/state"
    assert stream_enrich.read_metrics(spark, log).count() == 0
    day = lambda d: datetime(2024, 1, d)
    batches = [[("a", 1, day(1)), ("a", 2, day(2)), ("b", -1, day(1))], [("a", 9, day(1)), ("b", 5, day(3))]]
    for batch in batches:
        spark.createDataFrame(batch, schemas.AUTHOR_METRICS).write.mode("append").parquet(source)
        stream = stream_merge.read_stream(spark, source, schemas.AUTHOR_METRICS)
        stream_enrich.stream_metrics(stream, log, state).awaitTermination()
    metrics = stream_enrich.read_metrics(spark, log)
    assert rows(metrics, "author_id", "follower_count") == [("a", 2), ("b", 5)]
    posts = spark.createDataFrame([("@a", -1), ("@c", -1)], "author_id string, follower_count long")
    assert rows(enrich.enrich_authors(posts, metrics)) == [("@a", 2), ("@c", -1)]
    stream_enrich.compact(spark, log, f"{tmp_path}/fresh")
    assert rows(stream_enrich.read_metrics(spark, f"{tmp_path}/fresh")) == rows(metrics)
