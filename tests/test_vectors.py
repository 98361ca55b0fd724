import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from trendloom.operators import quantiles, reports, vectors
from trendloom.plans import domain

V = "id int, embedding array<float>"


def frame(spark, matrix):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(matrix)], V)


def test_similarity_against_numpy(spark):
    rng = np.random.default_rng(1)
    x, refs = rng.normal(size=(60, 8)), rng.normal(size=(7, 8))
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    expected = (unit(x) @ unit(refs).T).max(axis=1)
    for block in (vectors.BLOCK, 2):
        got = vectors.max_similarity(frame(spark, x), frame(spark, refs), block=block)
        assert np.allclose([r["tech_similarity"] for r in got.orderBy("id").collect()], expected, atol=1e-6)
    centre = vectors.centroid_similarity(frame(spark, x), frame(spark, refs))
    expected = unit(x) @ unit(refs.mean(axis=0, keepdims=True))[0]
    assert np.allclose([r["tech_similarity"] for r in centre.orderBy("id").collect()], expected, atol=1e-6)


def test_zero_and_missing_vectors(spark):
    df = frame(spark, [[0, 0], None, [2, 0], [-1, 0]])
    got = rows(vectors.max_similarity(df, np.array([[1.0, 0.0]])), "id", "tech_similarity")
    assert got == [(0, 0.0), (1, None), (2, 1.0), (3, -1.0)]
    with pytest.raises(ValueError):
        vectors.max_similarity(df, frame(spark, [None]))


@pytest.mark.parametrize("values", [[0.5], [0.1, 0.3], [0.2, 0.2, 0.9], [-5.0, 0.0, 7.0, 8.0], [1.0] * 10])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "s double")
    assert quantiles.exact_median(df, "s").first()[0] == pytest.approx(float(np.median(values)), abs=1e-15)


@pytest.mark.parametrize("n", [999, 1000])
@pytest.mark.parametrize("accuracy", [20_000, 10, 4])
def test_exact_median_of_many(spark, n, accuracy):
    values = np.random.default_rng(n).beta(2, 5, n) * 1e-3
    values[: n // 3] = values[n // 2]
    df = spark.createDataFrame([(float(v),) for v in values], "s double").repartition(6)
    assert quantiles.exact_median(df, "s", accuracy).first()[0] == float(np.median(values))


def test_a_bracket_that_misses_is_replaced(spark, monkeypatch):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "s double")
    missed = quantiles.F.array(quantiles.F.lit(7.0), quantiles.F.lit(9.0))
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *_: quantiles.F.first(missed))
    assert quantiles.exact_median(df, "s").first()[0] == 5.0
    assert quantiles.exact_median(df.filter("s > 99"), "s").first()[0] is None


def test_stats_populations(spark):
    df = spark.createDataFrame([(0.1,), (0.5,), (0.9,)], "tech_similarity double")
    assert reports.similarity_stats(df, threshold=0.5).first()["n"] == 2
    assert reports.similarity_stats(df, threshold=0.5, population="all").first()["median"] == 0.5


def test_user_encoder_runs_once_per_text(spark):
    def load():
        def model(texts):
            return np.array([[len(t), 1.0] for t in texts])

        return model

    df = spark.createDataFrame([(1, "aa"), (2, "aa"), (3, None)], "id int, text string")
    encode = vectors.encoder(load)
    for once in (False, True):
        got = rows(vectors.embed(df, encode=encode, once_per_text=once).select("id", F.col("embedding")[0]))
        assert got[:2] == [(1, 2.0), (2, 2.0)] and len(got) == 3


def test_default_vectors_have_length_one(spark):
    df = spark.createDataFrame([("gpu chip gpu",), ("chip news",), (None,)], "text string")
    got = [np.linalg.norm(r["embedding"]) for r in vectors.embed(df, dim=32).collect()]
    assert got == pytest.approx([1.0, 1.0, 0.0], abs=1e-6)


def test_post_filter_threshold_is_inclusive(spark):
    posts = spark.createDataFrame(
        [("keep", [1.0, 0.0]), ("spam here", [1.0, 0.0]), ("off", [0.0, 1.0]), (None, [1.0, 0.0])],
        "text string, embedding array<float>",
    )
    kept = domain.domain_filter_posts(posts, np.array([[1.0, 0.0]]), ["SPAM"], 1.0)
    assert rows(kept, "text", "tech_similarity") == [("keep", 1.0)]


def test_word_filter_runs_before_python(spark):
    posts = spark.createDataFrame([("x", [1.0])], "text string, embedding array<float>")
    plan = domain.score_posts(posts, np.array([[1.0]]), ["spam"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Filter")


def test_video_filter_keeps_all_rows_of_a_title(spark):
    data = [("good", 1), ("good", 2), ("spam", 3), ("far", 4), (None, 5)]
    videos = spark.createDataFrame(data, "video_title string, seq int")
    titles = spark.createDataFrame(
        [("good", [1.0, 0.0]), ("spam", [1.0, 0.0]), ("far", [0.0, 1.0])], "video_title string, embedding array<float>"
    )
    kept = domain.domain_filter_videos(videos, frame(spark, [[2, 0], [2, 1]]), ["spam"], 0.9, titles)
    assert rows(kept, "seq") == [(1,), (2,)]
    assert kept.columns == ["video_title", "seq", "tech_similarity"]


def test_score_cross_names_references(spark):
    got = vectors.score_cross(frame(spark, [[1, 0], None]), np.array([[1.0, 0], [0, 1.0]]), ["x", "y"])
    scores = {r["id"]: r["scores"] for r in got.collect()}
    assert [(s["ref"], s["score"]) for s in scores[0]] == [("x", 1.0), ("y", 0.0)]


def test_vectors_of_unequal_length_are_refused():
    with pytest.raises(ValueError, match="2 to 4"):
        vectors._as_matrix(pa.array([[1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]))
    assert vectors._as_matrix(pa.array([[1.0, 2.0], None]))[1].shape == (1, 2)
