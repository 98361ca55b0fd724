import math
import random
import re
import zlib

import numpy as np
import pytest

from trendloom.llm import subwords

BITS = 10


def plain(text, bits=BITS):
    """Counts of features, one at a time."""
    mask = (1 << 64) - 1
    step, mix, pair, repeat = map(int, (subwords.STEP, subwords.MIX, subwords.PAIR, subwords.REPEAT))

    def bucket(h, kind):
        h = (h + kind) * mix & mask
        h ^= h >> 29
        return (h * mix & mask) >> (64 - bits)

    out = {}
    add = lambda b: out.__setitem__(b, out.get(b, 0) + 1)
    before = None
    for word in re.findall(rb"[^\x20\x09-\x0d]+", text or b""):
        padded = b" " + word + b" "
        for n in (3, 4, 5):
            for i in range(len(padded) - n + 1):
                h = 0
                for c in padded[i : i + n]:
                    h = (h * step + c) & mask
                add(bucket(h, n))
        own = 0
        for j, c in enumerate(word):
            own = (own + (c + 1) * pow(step, j, 1 << 64)) & mask
        add(bucket(own, 1))
        if before is not None:
            add(bucket(repeat if before == own else (before * pair + own) & mask, 2))
        before = own
    return out


def texts():
    rng = random.Random(4)
    words = ["the", "a", "Éa", "stone", "x", "!!!", "under\x0bline", "very", "wörd", "no\x00w"]
    out = [" ".join(rng.choices(words, k=rng.randint(1, 60))).encode() for _ in range(30)]
    return out + [b"", None, b" \t\n ", b"one", b"a a a a", b"  lead", b"trail  ", b"x" * 400, b"\xe2\x80\x83wide"]


@pytest.mark.parametrize("piece", [1 << 17, 64])
def test_features_equal_a_plain_count(monkeypatch, piece):
    monkeypatch.setattr(subwords, "PIECE", piece)
    own = [t for t in texts() if piece > 64 or t is None or len(t) < 400]
    got = subwords.features_of(own, BITS)
    assert [dict(zip(i.tolist(), n.tolist())) for i, n in got] == [plain(t) for t in own]


def test_a_step_follows_the_gradient():
    rng = np.random.default_rng(1)
    model = subwords.Model((0, 1, 2), rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    ids, n, own = np.array([1, 4, 6]), np.array([2, 1, 1]), 2

    def loss(vectors, weights, bias):
        z = (n / n.sum()) @ vectors[ids] @ weights + bias
        return math.log(np.exp(z).sum()) - z[own]

    after = subwords.descend(model, [(ids, n, own)], 1e-6)
    for name, rate in (("vectors", subwords.VECTOR_RATE), ("weights", 1.0), ("bias", subwords.BIAS_RATE)):
        given = {k: getattr(model, k) for k in ("vectors", "weights", "bias")}
        got = (getattr(model, name) - getattr(after, name)) / (1e-6 * rate)
        for at in np.ndindex(given[name].shape):
            more, less = given[name].copy(), given[name].copy()
            more[at] += 1e-5
            less[at] -= 1e-5
            slope = (loss(**given | {name: more}) - loss(**given | {name: less})) / 2e-5
            tolerance = 1e-2 if name == "vectors" else 1e-4
            assert abs(slope - got[at]) < tolerance, (name, at)


def cases(n, seed):
    rng = random.Random(seed)
    good = lambda: " ".join(rng.choices(["river", "stone", "walks", "under", "green", "hill"], k=30))
    bad = [lambda: " ".join(w + "%%%" for w in good().split()), lambda: rng.choice("river stone hill".split() + ["new"]) * 1 + " same" * 30, lambda: good().upper()]
    return [(i, good() if i % 2 else bad[i % 3](), i % 2) for i in range(n)]


def test_held_out_texts_are_told_apart(spark):
    own = cases(400, 1)
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in own], "doc_id long, text string, order string, score double").repartition(5)
    labels = spark.createDataFrame([(i, q) for i, _, q in own] + [(0, None), (1, 7), (None, 1), (3, 1)], "doc_id long, quality int")
    learn = ~subwords.held_out(subwords.F.col("doc_id"))
    model = subwords.fit(docs, labels.filter(learn))
    got = {r.doc_id: r.score for r in subwords.scores(docs, model, 1).collect()}
    apart = [(q, got[i]) for i, _, q in own if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(got) == 400 and len(apart) > 50 and all((s >= 0.3) == bool(q) for q, s in apart)
    again = subwords.fit(docs.repartition(3), labels.filter(learn))
    assert (again.gains() == model.gains()).all()


def test_scores_equal_the_mean_of_vectors(spark):
    rng = np.random.default_rng(3)
    model = subwords.Model(("a", "b", "c"), rng.normal(size=(1 << BITS, 4)).astype(np.float32), rng.normal(size=(4, 3)), rng.normal(size=3))
    rows = [(i, None if t is None else t.decode(), "k") for i, t in enumerate(texts())] + [(None, "no id", "k"), (3, "same id", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _text string").repartition(3)
    for r in subwords.scores(df, model, "b", ("doc_id", "text", "_text")).collect():
        found = plain((r.text or "").encode())
        mean = sum(model.vectors[b].astype(float) * n for b, n in found.items()) / max(sum(found.values()), 1) if found else np.zeros(4)
        z = np.exp(mean @ model.weights + model.bias)
        assert abs(r.score - z[1] / z.sum()) < 1e-6 and r._text == "k"


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in subwords.scores(docs, subwords.fit(docs, none), 1).collect()} == {0.5}
    one = subwords.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert all(r.score > 0.5 for r in subwords.scores(docs, one, 1).collect())
    assert subwords.scores(docs.limit(0), one, 1).collect() == []
