import glob
import os
from datetime import datetime

import pytest
from conftest import rows

from trendloom.plans import enrichment
from trendloom.sources import snapshots

POSTS = "seq int, author_id string, follower_count long"
METRICS = "author_id string, follower_count long, crawled_at timestamp"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def counts(spark, path, version=None):
    return rows(snapshots.read(spark, path, snapshots.current(spark, path, version)), "seq", "follower_count")


def test_enrichment_job(spark, tmp_path):
    """A pending author gets the count on every row, known counts stay, no helper column is left."""
    path = f"{tmp_path}/posts"
    data = [(1, "@test_new", -1), (2, "@test_existing", 500), (3, "\t test_new\n", 7), (4, "other", None), (5, None, -1)]
    posts = spark.createDataFrame(data, POSTS).selectExpr("*", "author_id AS author_id_clean")
    assert snapshots.current(spark, path) is None
    assert enrichment.start(posts, path, buckets=16).version == 1
    assert rows(enrichment.pending(spark, path)) == [("other",), ("test_new",)]
    answers = [("@test_new", 1, T1), ("test_new", 12345, T2), ("test_existing", 9, T2), ("other", -1, T2)]
    metrics = spark.createDataFrame(answers, METRICS)
    assert enrichment.apply_metrics(spark, path, metrics).version == 2
    assert counts(spark, path) == [(1, 12345), (2, 500), (3, 12345), (4, -1), (5, -1)]
    assert counts(spark, path, 1) == [(1, -1), (2, 500), (3, 7), (4, -1), (5, -1)]
    assert snapshots.current(spark, path).schema.fieldNames() == ["seq", "author_id", "follower_count"]
    # Nothing new to write: the version stays.
    assert enrichment.apply_metrics(spark, path, metrics).version == 2


def test_only_changed_buckets_are_rewritten(spark, tmp_path):
    path = f"{tmp_path}/posts"
    data = [(i, f"@u{i % 40}", -1) for i in range(400)]
    first = enrichment.start(spark.createDataFrame(data, POSTS), path, buckets=8)
    metrics = spark.createDataFrame([("u1", 10, T1), ("u2", 0, T1)], METRICS)
    second = enrichment.apply_metrics(spark, path, metrics)
    moved = {b for b in first.folders if first.folders[b] != second.folders[b]}
    assert 1 <= len(moved) <= 2 < len(first.folders) and set(first.folders) == set(second.folders)
    assert counts(spark, path) == [(i, {1: 10, 2: 0}.get(i % 40, -1)) for i in range(400)]


def test_dead_writer_leaves_the_old_version(spark, tmp_path):
    path = f"{tmp_path}/posts"
    base = enrichment.start(spark.createDataFrame([(1, "a", -1), (2, "b", 2)], POSTS), path, buckets=4)
    rows_of = snapshots.read(spark, path, base)
    # It wrote files, and a draft of a manifest, and died before the commit.
    snapshots._written(rows_of.selectExpr("seq + 10 AS seq", "author_id", "follower_count"), path, base)
    with open(f"{path}/drafts/half", "w") as half:
        half.write('{"version": 2, "sch')
    assert counts(spark, path) == [(1, -1), (2, 2)]
    metrics = spark.createDataFrame([("a", 5, T1)], METRICS)
    assert enrichment.apply_metrics(spark, path, metrics).version == 2
    assert counts(spark, path) == [(1, 5), (2, 2)]


def test_two_writers(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/posts"
    base = enrichment.start(spark.createDataFrame([(1, "a", -1), (2, "b", -1)], POSTS), path, buckets=4)
    same = snapshots.read(spark, path, base)
    everything = list(range(4))
    first, write = spark.createDataFrame([("a", 5, T1)], METRICS), snapshots.replace
    late = spark.createDataFrame([("b", 6, T1)], METRICS)

    def overtaken(*args):
        monkeypatch.setattr(snapshots, "replace", write)
        assert enrichment.apply_metrics(spark, path, late).version == 2
        return write(*args)

    monkeypatch.setattr(snapshots, "replace", overtaken)
    assert enrichment.apply_metrics(spark, path, first).version == 3
    assert counts(spark, path) == [(1, 5), (2, 6)]
    with pytest.raises(snapshots.Conflict):
        snapshots.replace(same, path, base, everything)
    assert len(glob.glob(f"{path}/commits/*.json")) == 3


def test_buckets_may_empty_and_tables_too(spark, tmp_path):
    path = f"{tmp_path}/t"
    base = snapshots.create(spark.range(20).withColumnRenamed("id", "k"), path, "k", 4)
    full = snapshots.read(spark, path, base)
    gone = sorted(base.folders)[0]
    emptied = snapshots.replace(full.limit(0), path, base, [gone])
    assert gone not in emptied.folders
    left = rows(full.filter(base.bucket() != gone))
    assert rows(snapshots.read(spark, path, snapshots.current(spark, path))) == left
    with pytest.raises(ValueError):
        snapshots.replace(full, path, emptied, [gone])
    nothing = snapshots.create(spark.range(0), f"{tmp_path}/none", "id")
    assert rows(snapshots.read(spark, f"{tmp_path}/none", nothing)) == []
    with pytest.raises(ValueError):
        snapshots.create(spark.range(1).withColumnRenamed("id", "_bucket"), f"{tmp_path}/x", "1")


def test_start_from_newest_dump(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    for i, (name, author) in enumerate([("merged_2.csv", "new"), ("merged_1.csv", "old")]):
        (tmp_path / "in" / name).write_text(f"seq,author_id,follower_count\n{i},@{author},\n")
        os.utime(tmp_path / "in" / name, (1_700_000_000 - i, 1_700_000_000 - i))
    schema = spark.createDataFrame([], POSTS).schema
    enrichment.start_from_newest(spark, f"{tmp_path}/in", f"{tmp_path}/t", schema, ["merged_*.csv", "filtered_*.csv"], 4)
    assert rows(enrichment.pending(spark, f"{tmp_path}/t")) == [("new",)]
