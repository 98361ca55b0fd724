from conftest import rows
from pyspark.sql import functions as F

from trendloom import schemas
from trendloom.operators import keywords
from trendloom.sources import extract


def info(spark, lines, dialect="video"):
    df = spark.createDataFrame([(lines,)], "l array<string>")
    views, date = extract.video_info(F.col("l"), dialect)
    return tuple(df.select(views.alias("v"), date.alias("d")).first())


def test_info_lines(spark):
    assert info(spark, ["70,454 views", "3 weeks ago"]) == (70454, "3 weeks ago")
    assert info(spark, ["5일 전 스트리밍", "2024. 1. 2."]) == (0, "2024. 1. 2.")
    # A second views line that also looks like a date serves as the date.
    assert info(spark, ["조회수 10회", "조회수 3주 전"]) == (10, "조회수 3주 전")
    assert info(spark, ["조회수 없음", "조회수 3주 전"]) == (3, None)
    assert info(spark, []) == (0, None)
    assert info(spark, ["조회수 1.2만회"]) == (0, None)
    assert info(spark, ["조회수 1.2만회"], "video_fixed") == (12000, None)


def test_page_source(spark):
    cases = {
        '"viewCount":"12","originalViewCount":"9"': 12,
        '"originalViewCount":"9"': 9,
        '"viewCount":{"simpleText":"1.5만회"}': 15000,
        '"viewCount":"0" "originalViewCount":"9"': 0,
        "": 0,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = dict(rows(df.select("s", extract.count_from_source(F.col("s")))))
    assert got == cases
    one = spark.createDataFrame([('{"followers_count": 77}',)], "s string")
    assert one.select(extract.followers_from_source(F.col("s"))).first()[0] == 77


def likes(spark, candidates):
    df = spark.createDataFrame([(candidates,)], "c array<struct<text:string,label:string>>")
    return df.select(extract.likes_from_labels(F.col("c"))).first()[0]


def test_likes(spark):
    assert likes(spark, [("공유", "share 9"), ("1.2천", None)]) == 1200
    assert likes(spark, [("", "Like this 1,234")]) == 1234
    assert likes(spark, [("0", "좋아요 5개"), ("9", "")]) == 5
    assert likes(spark, [("12x", "nothing 3")]) == 0
    assert likes(spark, []) == 0


def test_videos_to_rows(spark):
    video = (
        1, "kw", "title", "/watch?v=1", "d" * 51, '"originalViewCount":"8"', ["x"], [("7", "")], ["3 views"],
        ["", "구독자 100만명"], [("c" * 14, "a", "3주 전"), ("c" * 15, None, None)],
    )
    short = (2, "kw", "t2", "/watch?v=2", "d" * 50, "", [], [], ["none", "3 views"], [], [])
    df = spark.createDataFrame([video, short], schemas.RAW_VIDEOS)
    fields = rows(extract.video_fields(df), "seq", "video_likes", "video_views", "channel_subscribers")
    assert fields == [(1, 7, 8, 1000000), (2, 0, 3, 0)]
    made = extract.video_rows(df, "2024-01-01")
    assert set(schemas.VIDEO_ROWS.fieldNames()) <= set(made.columns)
    assert rows(made, "seq", "type", "author") == [
        (0, "description", "Uploader(Desc)"), (1, "comment", "a"), (2, "comment", "unknown"),
    ]
    assert rows(keywords.comments_limit(made), "seq") == [(0,), (2,)]


def test_cards_to_posts(spark):
    cards = [
        (1, "q", "hello", None, "5 replies", "1.2K", None, "9 likes", "3,000 views", "https://x.com/ann"),
        (2, "q", "", "t", None, None, None, None, None, None),
        (3, "q", None, "t", None, None, None, None, None, None),
        (4, "q", "x", "2024", None, None, "1", "2", None, None),
    ]
    got = extract.post_card(spark.createDataFrame(cards, schemas.RAW_POSTS), "now")
    assert rows(got, "seq", "created_at", "reply", "retweet", "like", "view", "author_id") == [
        (1, "now", 5, 1200, 9, 3000, "@ann"), (4, "2024", 0, 0, 1, 0, "unknown"),
    ]
