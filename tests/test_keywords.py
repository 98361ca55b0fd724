import itertools
import math
import random

import pytest
from conftest import rows

from trendloom.operators import keywords


def test_build_queries(spark):
    df = spark.createDataFrame(
        [("Python",), ("Python",), ("생성형 AI-모델",), (None,), ("x " * 300,), ("(서버)",)], "keyword string"
    )
    got = rows(keywords.build_queries(df), "query", "keyword")
    assert got == [('"Python"', "Python"), ('"서버"', "(서버)"), ("생성형 AI모델", "생성형 AI-모델")]


def test_optional_query_parts(spark):
    df = spark.createDataFrame([("a b",)], "keyword string")
    got = keywords.build_queries(
        df, lang="ko", min_reposts=5, until="2024-03-01", days=30, exclude=["x", "y"]
    ).first()["query"]
    assert got == "a b lang:ko -filter:retweets min_retweets:5 -x -y since:2024-01-31 until:2024-03-01"


@pytest.mark.parametrize("n,size", [(4, 2), (9, 2), (9, 3), (30, 2), (12, 1)])
def test_combinations_are_different_real_sets(spark, n, size):
    words = [f"w{i}" for i in range(n)]
    df = spark.createDataFrame([(w,) for w in words], "keyword string")
    got = [tuple(sorted(r["keyword"].split(" "))) for r in keywords.keyword_combinations(df, size=size).collect()]
    valid = {tuple(sorted(c)) for c in itertools.combinations(words, size)}
    assert len(got) == len(set(got)) == min(50, len(valid))
    assert set(got) <= valid


@pytest.mark.parametrize("n,size", [(6, 2), (7, 3), (5, 5)])
def test_unrank_lists_all_sets_in_order(n, size):
    got = [tuple(keywords._unrank(i, n, size)) for i in range(math.comb(n, size))]
    assert got == list(itertools.combinations(range(n), size))


@pytest.mark.parametrize("block_bytes", [8 << 20, 1])
def test_detect_keyword(spark, block_bytes):
    posts = spark.createDataFrame(
        [(1, "q", "about gpu and AI", 1), (2, "q", "none", 1), (3, "other", "x", 1), (4, "q", None, 1), (5, "q", "an ai", 1),
         (6, "e", "any", 1), (7, "e", None, 1), (8, None, "gpu", 1), (9, "q", "gpu", 1), (9, "q", "gpu", 1)],
        "seq int, search_query string, text string, _best int",
    )
    pairs = spark.createDataFrame(
        [("q", 2, "ai"), ("q", 1, "GPU"), ("q", 1, "gpu"), ("q", 0, "tpu"), ("r", 0, "z"), ("e", 3, "zz"), ("e", 4, ""), (None, 0, "x"), ("q", 9, None)],
        "search_query string, pos int, keyword string",
    )
    got = keywords.detect_keyword(posts, pairs, block_bytes=block_bytes)
    expected = [(1, "GPU"), (2, "tpu"), (4, "tpu"), (5, "ai"), (6, ""), (7, "zz"), (9, "GPU"), (9, "GPU")]
    assert rows(got, "seq", "search_keyword") == expected and "_best" in got.columns
    assert keywords.detect_keyword(posts, pairs.limit(0)).count() == 0


def test_detect_keyword_equals_python(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdE ") for _ in range(rng.randint(1, 5)))
    lists = {q: [word() for _ in range(rng.randint(1, 300))] for q in "pqrs"}
    data = [(i, rng.choice("pqrst"), "".join(rng.choice("abcdefE ") for _ in range(rng.randint(0, 30)))) for i in range(400)]
    posts = spark.createDataFrame(data, "seq int, search_query string, text string").repartition(3)
    pairs = spark.createDataFrame([(q, i, k) for q, ks in lists.items() for i, k in enumerate(ks)], "search_query string, pos int, keyword string")
    got = dict(rows(keywords.detect_keyword(posts, pairs), "seq", "search_keyword"))
    first = lambda t, ks: next((k for k in ks if k.lower() in t.lower()), ks[0])
    assert got == {i: first(t, lists[q]) for i, q, t in data if q in lists}
    plan = keywords.detect_keyword(posts, pairs)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan


def test_limit_per_query_order_of_steps(spark):
    posts = spark.createDataFrame(
        [(1, "q", "bad a"), (2, "q", "x"), (3, "q", "x"), (4, "q", "y"), (5, "q", "z"), (6, "r", "x")],
        "seq int, search_query string, text string",
    )
    got = keywords.limit_per_query(posts, 2, ["bad"])
    assert rows(got, "seq", "rank") == [(2, 1), (4, 2), (6, 1)]
    report = rows(keywords.scan_report(posts, ["bad"]), "search_query", "scanned", "kept", "noise", "repeated")
    assert report == [("q", 5, 3, 1, 1), ("r", 1, 1, 0, 0)]


def test_comments_limit(spark):
    data = [(0, "v", "Uploader(Desc)", "d" * 60, "description")]
    data += [(1, "v", "a", "short comment.", "comment"), (2, "v", "a", "fifteen letters", "comment")]
    data += [(3, "v", "a", "fifteen letters", "comment"), (4, "v", "b", "fifteen letters", "comment")]
    data += [(5, "v", "c", "another long comment", "comment"), (6, "w", "c", "another long comment", "comment")]
    df = spark.createDataFrame(data, "seq int, video_url string, author string, comment string, type string")
    assert rows(keywords.comments_limit(df, 2), "video_url", "seq") == [("v", 0), ("v", 2), ("v", 4), ("w", 6)]


def test_videos_per_keyword_skips_shorts(spark):
    data = [(i, "k", "/shorts/x" if i % 2 else f"/watch?v={i}") for i in range(30)]
    df = spark.createDataFrame(data, "seq int, search_keyword string, url string")
    assert rows(keywords.videos_per_keyword(df, 3), "seq") == [(0,), (2,), (4,)]
