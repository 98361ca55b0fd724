from datetime import datetime

from conftest import rows

from trendloom.operators import enrich

POSTS = "seq int, author_id string, follower_count long"
METRICS = "author_id string, follower_count long, crawled_at timestamp"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_new_known_and_helper_column(spark):
    """The three facts: -1 is replaced, a known count stays, no helper column is left."""
    posts = spark.createDataFrame([(1, "@test_new", -1), (2, "@test_existing", 500)], POSTS)
    answers = spark.createDataFrame([("test_new", 12345, T1), ("test_existing", 12345, T1)], METRICS)
    asked = enrich.pending_authors(posts)
    assert rows(asked) == [("test_new",)]
    answered = answers.join(asked.withColumnRenamed("author", "author_id"), "author_id", "left_semi")
    done = enrich.enrich_authors(posts, answered)
    assert rows(done, "author_id", "follower_count") == [("@test_existing", 500), ("@test_new", 12345)]
    assert done.columns == posts.columns


def test_edge_rows(spark):
    posts = spark.createDataFrame(
        [(1, " @a ", -1), (2, "a", 7), (3, "b", None), (4, None, -1), (5, "c", -1), (6, "@", -1)], POSTS
    )
    metrics = spark.createDataFrame(
        [("@a", 10, T1), ("a", 20, T2), ("b", -1, T2), ("c", 0, T1), ("c", -1, T2)], METRICS
    )
    done = enrich.enrich_authors(posts, metrics, ["seq"])
    assert rows(done, "seq", "follower_count") == [(1, 20), (2, 20), (3, -1), (4, -1), (5, 0), (6, -1)]
    assert rows(enrich.pending_authors(posts)) == [("a",), ("b",), ("c",)]
    assert rows(enrich.pending_authors(posts, metrics)) == [("b",)]


def test_missing_column_starts_pending(spark):
    posts = spark.createDataFrame([("@a",)], "author_id string")
    assert rows(enrich.with_follower_count(posts)) == [("@a", -1)]


def test_progress(spark):
    posts = spark.createDataFrame([(1, "a", -1), (2, "a", 5), (3, "b", 5), (4, "c", None)], POSTS)
    assert rows(enrich.progress(posts)) == [(3, 2, 1)]
