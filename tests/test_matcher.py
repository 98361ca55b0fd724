import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from trendloom.functions import matcher
from trendloom.functions.lookup import OpenTable


def cases(seed, n_words, n_texts, alphabet="ab.가ㅋ[ "):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(rng.randint(0, n)))
    return [text(6) for _ in range(n_words)], [text(60) for _ in range(n_texts)] + [None, "", "a" * 900, "ab" * 700]


@pytest.mark.parametrize("seed, n_words", [(1, 1), (2, 5), (3, 64), (4, 65), (5, 400)])
@pytest.mark.parametrize("size", [8 << 20, 100])
def test_matches_equal_python(monkeypatch, seed, n_words, size):
    monkeypatch.setattr(matcher, "SLICE", size)
    words, texts = cases(seed, n_words, 200)
    words += ["aa", "aaa", "ab" * 300] if n_words > 1 else []
    found = matcher.Matcher(words)
    got = list(zip(*(x.tolist() for x in found.matches(pa.array(texts)))))
    assert got == [(i, j) for i, t in enumerate(texts) if t is not None for j, w in enumerate(words) if w in t]
    assert found.any(pa.array(texts)).to_pylist() == [None if t is None else any(w in t for w in words) for t in texts]
    assert found.any(pa.array(texts)[50:90]).to_pylist() == [any(w in t for w in words) for t in texts[50:90]]


def test_no_strings_and_no_texts():
    none = matcher.Matcher([])
    assert none.any(pa.array(["a", None])).to_pylist() == [False, None]
    assert matcher.Matcher(["x"]).any(pa.array([], pa.string())).to_pylist() == []
    assert len(matcher.Matcher(["x"]).matches(pa.array([None, ""], pa.string()))[0]) == 0


def test_columns(spark):
    words, texts = cases(9, 90, 300)
    words = [w for w in words if w]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    got = dict(rows(df, "i", "t"))
    hit = dict(rows(df.select("i", matcher.holds_any(F.col("t"), words).alias("h"))))
    assert hit == {i: None if t is None else any(w in t for w in words) for i, t in got.items()}
    groups = [words[:30], words[20:40], [], [words[0], words[50]]]
    held = dict(rows(df.select("i", matcher.groups_held(F.col("t"), groups).alias("h"))))
    assert held == {i: [k for k, g in enumerate(groups) if t is not None and any(w in t for w in g)] for i, t in got.items()}


def test_open_table_finds_what_it_holds():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 62, 5000))
    table = OpenTable(len(keys))
    table.add(keys[:2000], np.arange(2000, dtype=np.int32))
    table.add(keys[2000:], np.arange(2000, len(keys), dtype=np.int32))
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(np.array([-1, -5, 1 << 62])) == -1).all() and (table.find(keys + 1) == np.where(np.isin(keys + 1, keys), 1, -1)).all()
