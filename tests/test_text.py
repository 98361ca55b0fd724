import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trendloom.functions import text as tx


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


def test_handles(spark):
    assert one(spark, " @a\t", tx.clean_handle) == "a"
    assert one(spark, "https://x.com/name", tx.handle_from_url) == "@name"
    assert one(spark, None, tx.handle_from_url) == "unknown"
    assert one(spark, "", tx.handle_from_url) == "unknown"


def test_clean_keyword_keeps_hangul(spark):
    assert one(spark, " 생성형 AI(모델)_v2! ", tx.clean_keyword) == "생성형 AI모델_v2"


def test_headlines(spark):
    assert one(spark, "a - b - c", tx.strip_publisher) == "a"
    assert one(spark, "plain", tx.strip_publisher) == "plain"


def test_created_at(spark):
    assert one(spark, "bad", tx.parse_created_at) is None
    assert str(one(spark, "2024-01-02T03:04:05.000Z", tx.parse_created_at)) == "2024-01-02 03:04:05"


def test_tokens_and_stopwords(spark):
    assert one(spark, "AI 칩 HBM4 a 삼성전자!", tx.tokens) == ["AI", "HBM4", "삼성전자"]
    kept = one(spark, "the cat the dog", lambda c: tx.drop_stopwords(tx.words(c), ["cat"]))
    assert kept == ["the", "the", "dog"]


def test_keep_tags(spark):
    df = spark.createDataFrame(
        [([("말", "NNG"), ("go", "SL"), ("하", "VV")],)], "t array<struct<form:string,tag:string>>"
    )
    got = df.select(
        tx.keep_tags(F.col("t"), prefixes=["N"]).alias("n"), tx.keep_tags(F.col("t"), tags=["SL"]).alias("s")
    ).first()
    assert got == (["말"], ["go"])


def test_ngrams(spark):
    def grams(tokens, low, high):
        return one(spark, tokens, lambda c: tx.ngrams(c, low, high), "array<string>")

    assert grams(["a", "b", "c"], 1, 2) == ["a", "b", "c", "a b", "b c"]
    assert grams(["a", "b", "c"], 3, 3) == ["a b c"]
    assert grams(["a"], 1, 2) == ["a"]
    assert grams([], 1, 2) == []


def test_contains_any_with_signs(spark):
    texts = ["a.b", "axb", "x[y", "^", "tab\t", "1-2", "ㅋㅋ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", tx.contains_any(F.col("t"), ["a.b", "[y", "^", "\t", "-", "ㅋㅋ"]).alias("hit"))
    assert [h for _, h in sorted(rows(got))] == [True, False, True, True, True, True, True, None]


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(tx.percent(F.col("a"), F.col("b"))).collect()] == [25.0, None]
