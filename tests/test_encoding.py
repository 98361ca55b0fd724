import hashlib
import math
import re
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trendloom.operators import encoding
from trendloom.plans import domain

TEXTS = ["Gpu chip gpu news", "chip 가나다 news", "", "x", None, "new GPU", "chip"]


def brute(texts, dim):
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % dim
    counts = [None if t is None else Counter(bucket(w) for w in re.findall("[가-힣a-zA-Z0-9]{2,}", t.lower())) for t in texts]
    full = [c for c in counts if c is not None]
    weights = [math.log((len(full) + 1) / (sum(b in c for c in full) + 1)) for b in range(dim)]
    out = []
    for c in counts:
        v = None if c is None else [c[b] * weights[b] for b in range(dim)]
        n = v and math.sqrt(sum(x * x for x in v))
        out.append(v and [x / n for x in v] if n else v)
    return weights, out


@pytest.mark.parametrize("dim", [4, 64])
def test_encoder_equals_brute_force(spark, tmp_path, monkeypatch, dim):
    monkeypatch.setattr(encoding, "SLICE", 2)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    encode = encoding.fit(df, dim=dim)
    weights, want = brute(TEXTS, dim)
    assert encode.weights.tolist() == pytest.approx(weights)
    encode.save(spark, f"{tmp_path}/encoder")
    again = encoding.HashedTfidf.load(spark, f"{tmp_path}/encoder")
    assert again.weights.tolist() == encode.weights.tolist() and again.pattern == encode.pattern
    got = [r["v"] for r in df.coalesce(1).select("id", again(F.col("text")).alias("v")).orderBy("id").collect()]
    assert [g is None for g in got] == [w is None for w in want]
    for g, w in zip(got, want):
        assert g is None or g == pytest.approx(w)
    assert encoding.fit(df.limit(0), dim=dim).weights.tolist() == [0.0] * dim


def test_sentences_and_posts_lie_in_one_space(spark):
    posts = spark.createDataFrame([(1, "gpu chip news"), (2, "bond trader news"), (3, "GPU spam"), (4, None), (5, "")], "id int, text string")
    encode = encoding.fit(posts, dim=4096)
    scored = domain.score_posts(posts, ["a new gpu chip", "unseen words"], ["spam"], encode=encode)
    got = dict(rows(scored, "id", "tech_similarity"))
    assert set(got) == {1, 2, 5} and got[1] > 0.4 > got[2] == got[5] == 0.0
    table = spark.createDataFrame([("a new gpu chip",), ("unseen words",)], "text string")
    assert dict(rows(domain.score_posts(posts, table, ["spam"], encode=encode), "id", "tech_similarity")) == pytest.approx(got)
    report = rows(domain.post_report(posts, table, ["spam"], 0.4, encode=encode), "step", "before", "after")
    assert sorted(report) == [("similarity", 3, 1), ("words", 5, 3)]
    with pytest.raises(ValueError, match="encoder"):
        domain.score_posts(posts, ["a"], [])


def test_least_vector_of_a_title(spark):
    titles = spark.createDataFrame([("t", [1.0, 0.0]), ("t", [0.0, 1.0]), ("t", None)], "video_title string, embedding array<double>")
    got = domain.score_titles(titles.repartition(3), spark.createDataFrame([([0.0, 1.0],)], "embedding array<double>"), [])
    assert rows(got, "tech_similarity") == [(1.0,)]


def test_slices_give_the_same_vectors(spark, monkeypatch):
    """Vectors and scores are made in slices, with null and empty texts at their borders."""
    import numpy as np

    from trendloom.operators import vectors

    texts = [None, "", "one two", None, "two three four", "", "four", None, "one one", "three"] * 7
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").coalesce(1)
    refs = np.random.default_rng(0).normal(size=(3, 16))
    encode = encoding.fit(df, dim=16)

    def made():
        scored = vectors.max_similarity(df.withColumn("embedding", encode(df["text"])), refs)
        return [tuple(r) for r in scored.orderBy("doc_id").collect()]

    whole = made()
    monkeypatch.setattr(encoding, "SLICE", 4)
    monkeypatch.setattr(vectors, "SLICE", 3)
    for (i, text, v, s), (j, _, w, t) in zip(whole, made(), strict=True):
        assert i == j and (v is None) == (w is None) == (text is None) == (s is None)
        assert v is None or (np.allclose(v, w) and np.isclose(s, t))
