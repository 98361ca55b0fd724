import os
import random
import time

import pytest
from conftest import rows

from trendloom import schemas
from trendloom.operators import enrich
from trendloom.plans import merge
from trendloom.sources import dumps, quoted, sinks

HEADER = "text,reply,retweet,like,view,author_id,created_at,search_keyword,search_query\n"


@pytest.fixture
def folder(tmp_path):
    files = {
        "a.csv": "﻿" + HEADER
        + 'same,1,0,0,0,@a,2024-01-01,k,q\n"line one\nline ""two""",2.0,0,0,0,@b,bad,k,q\n,3,0,0,0,@c,,k,q\nNA,4,0,0,0,@d,,k,q\n',
        "b.csv": "text,reply,search_query\nsame,9,q\nother,5,q\n,6,q\n",
        "c.csv": "search_query,text\nq,third order\n",
        "empty.csv": "",
        "d.csv": HEADER + "broken,1\n",
        "note.txt": "not a dump",
    }
    for name, body in files.items():
        (tmp_path / name).write_text(body, encoding="utf-8")
    return str(tmp_path)


def test_folder_of_unlike_files(spark, folder):
    df = dumps.read_dumps(spark, folder, schemas.POSTS)
    got = {(r["text"], r["reply"], r["author_id"]) for r in dumps.good_rows(df).collect()}
    assert got == {
        ("same", 1, "@a"), ('line one\nline "two"', 2, "@b"), (None, 3, "@c"), ("NA", 4, "@d"),
        ("same", 9, None), ("other", 5, None), (None, 6, None), ("third order", None, None),
    }
    profile = {r["file_name"]: (r["rows"], r["bad_rows"]) for r in dumps.input_profile(df).collect()}
    assert profile == {"a.csv": (4, 0), "b.csv": (3, 0), "c.csv": (1, 0), "d.csv": (1, 1)}
    size = {r["file_name"]: r["file_size"] for r in dumps.input_profile(df).collect()}
    assert size["b.csv"] == os.path.getsize(f"{folder}/b.csv")


def test_merge_keeps_the_first_file(spark, folder):
    got = merge.merge_post_dumps(spark, folder)
    assert got.columns == schemas.POSTS.fieldNames()
    texts = {r["text"]: r["reply"] for r in got.collect()}
    assert texts == {"same": 1, 'line one\nline "two"': 2, None: 3, "NA": 4, "other": 5, "third order": None}
    assert merge.merge_post_dumps(spark, folder, na_values=["NA"]).count() == 5


def test_merge_of_video_dumps(spark, tmp_path):
    line = "t,u,a,c,comment,,1,2,3,,2024-01-01,{}\n"
    head = ",".join(schemas.VIDEO_ROWS.fieldNames()) + "\n"
    (tmp_path / "1.csv").write_text(head + line.format("k1") * 2 + line.format("k2"))
    (tmp_path / "2.csv").write_text(head + line.format("k1"))
    assert rows(merge.merge_video_dumps(spark, str(tmp_path)), "search_keyword") == [("k1",), ("k2",)]


def test_empty_folder(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    assert dumps.read_dumps(spark, str(tmp_path), schemas.POSTS).count() == 0


def test_latest_snapshot_and_fallback(spark, tmp_path):
    for i, name in enumerate(["merged_1.csv", "merged_2.csv", "filtered_9.csv"]):
        (tmp_path / name).write_text(f"text\nfrom {name}\n")
        os.utime(tmp_path / name, (time.time() - 100 + i, time.time() - 100 + i))
    pick = lambda *globs: rows(dumps.latest_snapshot(spark, str(tmp_path), schemas.POSTS, globs), "text")
    assert pick("merged_*.csv", "filtered_*.csv") == [("from merged_2.csv",)]
    assert pick("nothing_*.csv", "filtered_*.csv") == [("from filtered_9.csv",)]
    assert pick("nothing_*.csv") == []


def test_keyword_files(spark, tmp_path):
    (tmp_path / "bom.csv").write_text("﻿id,Trend_Keyword\n1,생성형 AI\n2,칩\n", encoding="utf-8")
    assert rows(dumps.read_keywords(spark, str(tmp_path / "bom.csv"))) == [("생성형 AI",), ("칩",)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("가,\n나", 1), ("b", 2)], "text string, n int")
    sinks.write_table(df, f"{tmp_path}/csv", "csv")
    part = next(p for p in (tmp_path / "csv").iterdir() if p.suffix == ".csv")
    assert part.read_bytes().startswith(b"\xef\xbb\xbf")
    sinks.write_table(df, f"{tmp_path}/pq", partition_by=["n"])
    assert (tmp_path / "pq" / "n=1").is_dir()
    sinks.append_dump(df, f"{tmp_path}/log", "2024-01-01")
    sinks.append_dump(df, f"{tmp_path}/log", "2024-01-02")
    assert rows(spark.read.parquet(f"{tmp_path}/log").groupBy("crawl_date").count(), "count") == [(2,), (2,)]


def test_versions(spark, tmp_path):
    path = f"{tmp_path}/posts"
    assert sinks.latest_version(spark, path) is None
    posts = spark.createDataFrame([("@a", -1, "a")], "author_id string, follower_count long, author_id_clean string")
    assert sinks.save_version(posts, path) == 1
    metrics = spark.sql("SELECT 'a' AS author_id, 9L AS follower_count, timestamp'2024-01-01' AS crawled_at")
    assert sinks.save_version(enrich.enrich_authors(sinks.read_version(spark, path), metrics), path) == 2
    assert rows(sinks.read_version(spark, path)) == [("@a", 9)]
    assert rows(sinks.read_version(spark, path, 1)) == [("@a", -1)]
    os.makedirs(f"{path}/version=3")  # a write that never finished
    assert sinks.latest_version(spark, path) == 2


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def messy(seed, end, n=60):
    """Rows with line breaks, quotes, commas, empty lines and missing values."""
    rng = random.Random(seed)
    value = lambda: "".join(rng.choice(["a", "b", "가", ",", '"', end, " ", "x" * 30]) for _ in range(rng.randint(0, 12)))
    cell = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\r\n') or rng.random() < 0.2 else v
    lines = ["n,a,b"]
    for i in range(n):
        lines.append(f"{i}," + ",".join(cell(value()) for _ in range(1 if i % 29 == 0 else 2)))
        lines += [""] * (i % 11 == 0)
    lines.append('998,5" disc,"abc"def')
    return end.join(lines) + (end if seed % 2 else "")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("rows_to_send", [500_000, 0])
def test_split_files_equal_the_one_task_reader(spark, tmp_path, small_splits, monkeypatch, end, rows_to_send):
    monkeypatch.setattr(quoted, "BROADCAST_ROWS", rows_to_send)
    for seed in range(2):
        (tmp_path / f"{seed}.csv").write_bytes((("\ufeff" if seed == 1 else "") + messy(seed, end)).encode())
    schema = dumps.T.StructType([dumps.T.StructField(c, dumps.T.StringType()) for c in ("n", "a", "b")])
    got = dumps.read_dumps(spark, str(tmp_path), schema)
    records, _ = quoted.read_records(spark, str(tmp_path), "*.csv")
    assert records.rdd.getNumPartitions() > 5
    raw = schema.add(dumps.CORRUPT, "string", True)
    one = spark.read.schema(raw).options(header=True, multiLine=True, quote='"', escape='"', columnNameOfCorruptRecord=dumps.CORRUPT)
    key = ("file_name", "n", "a", "b")
    want = one.csv(f"{tmp_path}/*.csv").select("*", dumps.F.col("_metadata.file_name").alias("file_name"), dumps.F.col(dumps.CORRUPT).isNotNull().alias("bad"))
    assert rows(got.withColumn("bad", dumps.F.col(dumps.CORRUPT).isNotNull()), *key, "bad") == rows(want, *key, "bad")
    order = got.orderBy("file_name", "row_no").select("file_name", "n").collect()
    numbers = [str(i) for i in range(60)] + ["998"]
    assert [r["n"] for r in order] == numbers * 2 and got.select("file_name", "row_no").distinct().count() == 122


def test_a_value_over_many_blocks_and_an_open_end(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(300))
    (tmp_path / "a.csv").write_text(f'\n\ntext,reply\n1st,1\n"{long}",2\nlast,3\n"never closed\n,x\n')
    df = dumps.read_dumps(spark, str(tmp_path), schemas.POSTS).orderBy("row_no").collect()
    assert [r["text"] for r in df][:3] == ["1st", long, "last"] and len(df) == 4 and [r["reply"] for r in df][:3] == [1, 2, 3]


def test_states_of_lines():
    cases = {'a,b': (False, True), 'a,"b': (True, False), '"a""': (True, False), 'x"y': (False, False), '""': (False, True), '"a"b"c,"': (True, True), 'a",""': (False, False)}
    for line, (outside, inside) in cases.items():
        assert (quoted.open_after(line, False), quoted.open_after(line, True)) == (outside, inside), line
