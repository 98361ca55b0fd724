import pytest
from conftest import rows
from pyspark.sql import functions as F

from trendloom.functions import counts

# raw, post, author, video, video_fixed
GOLDEN = [
    (None, 0, 0, 0, 0),
    ("", 0, 0, 0, 0),
    ("   ", 0, 0, 0, 0),
    ("7", 7, 7, 7, 7),
    ("1,234", 1234, 1234, 1234, 1234),
    ("1.2K", 1200, 1200, 1200, 1200),
    (" 1.2K ", 1200, 1200, 1200, 1200),
    ("3.4M", 3400000, 3400000, 3400000, 3400000),
    ("1.2만", 1, 12000, 12000, 12000),
    ("1.2만회", 1, 0, 12000, 12000),
    ("조회수 1.2만회", 1, 0, 0, 12000),
    ("조회수 70,454회", 70454, 70454, 70454, 70454),
    ("구독자 100만명", 100, 0, 1000000, 1000000),
    ("1.5백만", 1, 0, 0, 1500000),
    ("2억", 2, 2, 200000000, 200000000),
    ("5천", 5, 5, 5000, 5000),
    ("abc", 0, 0, 0, 0),
    ("1.2.3", 1, 0, 0, 0),
    ("12 KT", 0, 0, 0, 0),
    ("1.2dK", 0, 0, 0, 0),
    ("InfinityK", 0, 0, 0, 0),
    ("nanK", 0, 0, 0, 0),
    ("1e3K", 1000000, 1000000, 1000000, 1000000),
    (".5K", 500, 500, 500, 500),
    ("5.K", 5000, 5000, 5000, 5000),
    ("-2K", -2000, -2000, -2000, -2000),
    ("12 replies", 12, 12, 12, 12),
    ("3.9 x", 3, 3, 3, 3),
    ("1.2K views", 0, 0, 1200, 1200),
    ("99999999999999999999", 0, 0, 0, 0),
]


@pytest.mark.parametrize("at,dialect", list(enumerate(["post", "author", "video", "video_fixed"], 1)))
def test_golden_values(spark, at, dialect):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "id int, raw string")
    got = df.select("id", counts.count_value(F.col("raw"), dialect).alias("v"))
    assert [(GOLDEN[i][0], v) for i, v in rows(got)] == [(g[0], g[at]) for g in GOLDEN]


def test_status_and_report(spark):
    df = spark.createDataFrame([(None,), ("",), ("5",), ("1K",), ("1.K.2K",), ("abc",)], "raw string")
    done = counts.normalise_counts(df, ["raw"], "post")
    assert done.columns == ["raw", "raw_status"]
    assert rows(done) == [
        (0, "empty"), (0, "empty"), (0, "failed"), (0, "none"), (5, "digits"), (1000, "unit"),
    ]
    report = dict(rows(counts.parse_report(df, "raw", "post")))
    assert report == {"empty": 2, "digits": 1, "unit": 1, "failed": 1, "none": 1}
