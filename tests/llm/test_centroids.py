import hashlib
import math
import random

import pytest

from trendloom.llm import centroids


def brute(rows, k=16, rounds=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * x) for x in v]))
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    cents = [x for _, x in sorted(((name(i), x) for i, x in kept))][:k]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    for r in range(rounds + 1):
        best = [min((far(x, c), n) for n, c in enumerate(cents)) for _, x in kept]
        if r < rounds:
            for n in range(len(cents)):
                own = [x for (_, x), (_, m) in zip(kept, best) if m == n]
                if own:
                    cents[n] = [sum(c) // len(own) for c in zip(*own)]
    spread = [sum(d for d, m in best if m == n) for n in range(len(cents))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, m, d, spread[m], sum(spread), sha[m]) for (i, _), (d, m) in zip(kept, best)), key=str)


def vectors(n, seed=1):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(i % 5, 1) / 8 for _ in range(64)]) for i in range(n)]
    out += [(i, out[0][1]) for i in range(n, n + n // 3)] + [(2, out[2][1]), (None, out[3][1]), (None, out[4][1])]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [float("nan")] * 64, [1.0] * 63 + [float("-inf")], [0.0] * 64]
    return out + [(1000 + i, v) for i, v in enumerate(odd)]


@pytest.mark.parametrize("n, k", [(150, 16), (6, 16), (60, 3)])
def test_clusters_equal_brute_force(spark, n, k):
    rows = vectors(n)
    df = spark.createDataFrame([(*r, "a", 5, 1.0) for r in rows], "vec_id long, embedding array<float>, dots string, cluster int, x double")
    single = [(r.vec_id, r.embedding) for r in df.collect()]
    got = centroids.described(*centroids.cluster(centroids.integers(df), k=k)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(single, k)


def test_products_are_corrected_not_computed_anew(spark):
    df = centroids.integers(spark.createDataFrame(vectors(80), "vec_id long, embedding array<float>"))
    state, cents = centroids.cluster(df, k=5, rounds=4)
    for r in state.collect():
        assert r.dots == [sum(a * int(b) for a, b in zip(r.x, c)) for c in cents] and r.own == sum(a * a for a in r.x)
    same, moves = centroids.moved(cents, [])
    assert moves == [] and (same == cents).all()


def test_edges(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None), (2, [])]):
        assert centroids.described(*centroids.cluster(centroids.integers(spark.createDataFrame(rows, schema)))).collect() == []
    with pytest.raises(Exception, match="too large"):
        centroids.integers(spark.createDataFrame([(1, [1e30] * 64)], schema)).collect()
