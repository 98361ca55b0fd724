import pytest
from conftest import rows
from pyspark.sql import functions as F

from trendloom import schemas
from trendloom.operators import dedup, filters, reports, skew


def test_excluded_words(spark):
    data = [(1, "about NowZ"), (2, "fine"), (3, None), (4, "the card game")]
    df = spark.createDataFrame(data, "id int, text string")
    assert rows(filters.drop_excluded(df, "text", ["NOWZ", "card game"]), "id") == [(2,)]
    strict = filters.drop_excluded(df, "text", ["NOWZ", "card game"], strict_reference=True)
    assert rows(strict, "id") == [(1,), (2,)]
    assert rows(filters.drop_excluded(df, "text", []), "id") == [(1,), (2,), (4,)]


def test_is_clean_keeps_null(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "Bad")], "id int, text string")
    assert rows(filters.is_clean(df, "text", ["bad"]), "id") == [(1,), (2,)]
    assert filters.is_clean(df, "text").count() == 3


def test_noise_titles(spark):
    titles = ["a", "ab", "abcd", "abcde", "ㅋㅋ abc", "ㅋㅋㅋ abc", "ㅇㅎ ㄷㅋㅇ", "wait.... x", "what???? x", "very!!! y"]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    loose = {r[0] for r in filters.noise_titles(df, "t", "loose").collect()}
    strict = {r[0] for r in filters.noise_titles(df, "t", "strict").collect()}
    noise = [s * 3 for s in filters.NOISE_SIGNS]
    assert loose == {t for t in titles if len(t) >= 2 and not any(n in t for n in noise)}
    assert strict == {"abcde", "wait.... x", "very!!! y"}
    with pytest.raises(ValueError):
        filters.title_is_noise(F.col("t"), "other")


def test_union_and_dedup_first(spark):
    a = spark.createDataFrame([(1, "x", "k"), (2, None, "k")], "seq int, text string, kw string")
    b = spark.createDataFrame([(3, "x", 9), (4, None, 9), (5, "y", 9)], "seq int, text string, n int")
    merged = dedup.union_by_name([a, b])
    assert set(merged.columns) == {"seq", "text", "kw", "n"}
    once = dedup.dedup_first(merged, ["text"], ["seq"])
    assert rows(once, "seq") == [(1,), (2,), (5,)]
    assert rows(dedup.dedup_first(once, ["text"], ["seq"]), "seq") == [(1,), (2,), (5,)]
    assert rows(reports.dedup_counts(merged, ["text"])) == [(5, 2, 3)]


@pytest.mark.parametrize("parts", [1, 7])
def test_dedup_does_not_depend_on_partitions(spark, parts):
    df = spark.range(1000).select("id", (F.col("id") % 37).cast("string").alias("text")).repartition(parts)
    assert rows(dedup.dedup_first(df, ["text"], ["id"]), "id") == [(i,) for i in range(37)]


def test_dedup_prefix_counts_characters(spark):
    long = "가" * 50
    df = spark.createDataFrame([(1, "q", long + "a"), (2, "q", long + "b"), (3, "r", long)], "seq int, q string, text string")
    assert rows(dedup.dedup_prefix(df, "text", "q", ["seq"]), "seq") == [(1,), (3,)]


@pytest.mark.parametrize("n", [1, 5, 2000])
def test_first_n_of_a_hot_key(spark, n):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    got = skew.first_n(df.repartition(9), ["k"], [F.col("id").desc()], n, rank="rank")
    hot = got.filter("k = 'hot'")
    expected = [i for i in range(4999, -1, -1) if i % 3][:n]
    assert [r["id"] for r in hot.orderBy("rank").collect()] == expected
    assert got.filter("k <> 'hot'").count() == 1667


@pytest.mark.parametrize("hot_rows", [10, 100_000])
def test_lookup_keeps_every_row_once(spark, hot_rows):
    def lookup(facts, how="left"):
        return skew.lookup(facts, dim, ["k"], ["id"], how, hot_rows=hot_rows)

    facts = spark.range(1000).select("id", F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("k"))
    dim = spark.createDataFrame([(1, "a"), (950, "b")], "k long, v string")
    assert lookup(facts).count() == 1000
    assert lookup(facts).columns == ["id", "k", "v"]
    assert rows(lookup(facts).groupBy("v").count()) == [(None, 99), ("a", 900), ("b", 1)]
    assert lookup(facts, "inner").count() == 901
    assert lookup(facts, "left_semi").count() == 901
    assert lookup(facts, "left_semi").columns == ["id", "k"]
    nulls = facts.withColumn("k", F.when(F.col("id") % 2 == 0, F.col("k")))
    assert lookup(nulls).filter("v IS NULL").count() == 549
    assert lookup(facts.limit(0)).count() == 0


def test_hot_facts_are_dealt_over_salts(spark):
    facts = spark.range(4000).select("id", F.lit(1).alias("k"))
    dim = spark.createDataFrame([(1, "a")], "k int, v string")
    plan = skew.lookup(facts, dim, ["k"], ["id"], hot_rows=10)
    assert "_salt" in plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count() == 4000


def test_hot_keys(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert rows(skew.hot_keys(df, "k", min_rows=5000)) == [(-1,)]
    assert skew.hot_keys(df, "k").count() == 0
    assert 1 <= skew.hot_keys(df, "k", limit=5, min_rows=1).count() <= 5
    assert skew.hot_keys(df.limit(0), "k").count() == 0


def test_dense_index_is_a_permutation(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    got = skew.dense_index(df, "k", "s")
    assert sorted(r["idx"] for r in got.collect()) == list(range(500))
    assert rows(got) == rows(skew.dense_index(df.repartition(5), "k", "s"))


def test_step_counts_add_up(spark):
    df = spark.range(100)
    steps = {"even": F.col("id") % 2 == 0, "big": F.when(F.col("id") > 9, F.col("id") > 49)}
    got = [tuple(r) for r in reports.step_counts(df, steps).orderBy("step_no").collect()]
    assert got == [(1, "even", 100, 50, 50, 50.0), (2, "big", 50, 25, 25, 25.0)]


def test_conform(spark):
    df = spark.createDataFrame([("t", 3)], "text string, like int")
    got = schemas.conform(df, schemas.POSTS)
    assert got.columns == schemas.POSTS.fieldNames()
    assert got.first() == ("t", 0, 0, 3, 0, "", "", "", "")
    with pytest.raises(ValueError):
        schemas.require(df, ["author_id"])
