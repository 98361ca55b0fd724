import math
import random
from collections import Counter
from itertools import combinations

import pytest
from conftest import rows

from trendloom.operators import coherence, terms

random.seed(5)
WORDS = [f"w{i}" for i in range(12)]
DOCS = [(i, i % 3 - 1, random.choices(WORDS, weights=range(1, 13), k=random.randint(1, 25))) for i in range(40)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id int, topic_id int, tokens array<string>").repartition(5)


def test_tfidf_by_hand(docs):
    n, df = len(DOCS), Counter(t for _, _, ts in DOCS for t in set(ts))
    vocab = {t for t, d in df.items() if 2 <= d <= 0.8 * n}
    expected = {}
    for i, _, ts in DOCS:
        w = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(ts).items() if t in vocab}
        norm = math.sqrt(sum(v * v for v in w.values()))
        expected |= {(i, t): v / norm for t, v in w.items()}
    got = {(r["doc_id"], r["term"]): r["weight"] for r in terms.tfidf(docs).collect()}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v) for k, v in expected.items())


def test_class_tfidf_by_hand(docs):
    counts = {c: Counter() for c in (-1, 0, 1)}
    for _, c, ts in DOCS:
        counts[c].update(ts)
        counts[c].update(f"{a} {b}" for a, b in zip(ts, ts[1:]))
    everywhere = sum(counts.values(), Counter())
    average = int(sum(everywhere.values()) / 3)
    expected = {
        (c, t): n / sum(k.values()) * math.log(average / everywhere[t] + 1) for c, k in counts.items() for t, n in k.items()
    }
    got = {(r["topic_id"], r["term"]): r["score"] for r in terms.class_tfidf(docs).collect()}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v) for k, v in expected.items())


def test_topic_keywords_shape(docs):
    table = terms.topic_keywords(docs, k=4)
    got = table.orderBy("topic_id", "rank").collect()
    assert [(r["topic_id"], r["rank"]) for r in got] == [(t, k) for t in (0, 1) for k in (1, 2, 3, 4)]
    assert got[0]["topic_name"] == " | ".join(r["keyword"] for r in got[:3])
    assert got[0]["doc_count"] == sum(1 for d in DOCS if d[1] == 0)
    sample = terms.topic_samples(table, 1, 2).collect()
    assert [r["keywords"] for r in sample] == [", ".join(r["keyword"] for r in got[:2])]


def test_cluster_keywords_orders(spark):
    docs = spark.createDataFrame(
        [(2, 0, ["b", "b", "c"]), (1, 0, ["a", "c", "c"]), (3, 1, ["Z"])], "doc_id int, cluster int, tokens array<string>"
    )
    seen = terms.cluster_keywords(docs, pool=2, k=2).orderBy("cluster", "place")
    assert [tuple(r) for r in seen.select("keyword", "cluster").collect()] == [("c", 1), ("b", 1), ("z", 2)]
    often = terms.cluster_keywords(docs, pool=3, k=3, emit="frequency").orderBy("cluster", "place")
    assert [r["keyword"] for r in often.collect()] == ["c", "b", "a", "z"]


def test_tagger_hook(spark):
    def load():
        return lambda text: [(w, "NNG" if w.isupper() else "VV") for w in text.split()]

    df = spark.createDataFrame([(1, "AB cd EF G"), (2, "x")], "doc_id int, text string")
    got = terms.tokenise(df, with_tagger=terms.tagger(load), stop=["EF"])
    assert rows(got, "doc_id", "tokens") == [(1, ["AB"])]


def _windows(tokens, size):
    if size is None or len(tokens) <= size:
        return [tokens]
    return [tokens[i : i + size] for i in range(len(tokens) - size + 1)]


@pytest.mark.parametrize("size, max_pairs", [(None, 99), (2, 99), (5, 99), (110, 99), (5, 0), (None, 0)])
def test_window_counts_by_brute_force(spark, docs, size, max_pairs):
    topics = spark.createDataFrame(
        [(t, w, r) for t, ws in enumerate([WORDS[:4], WORDS[3:8]]) for r, w in enumerate(ws, 1)],
        "topic_id int, term string, rank int",
    )
    windows = [set(w) for _, _, ts in DOCS for w in _windows(ts, size)]
    got = {(r["a"], r["b"]): (r["n_a"], r["n_b"], r["n_ab"], r["n"]) for r in coherence.window_counts(docs, topics, size, max_pairs).collect()}
    for ws in (WORDS[:4], WORDS[3:8]):
        for a, b in [*combinations(sorted(ws), 2), *((w, w) for w in ws)]:
            one = lambda w: sum(w in x for x in windows)
            assert got[a, b] == (one(a), one(b), sum(a in x and b in x for x in windows), len(windows))


def test_odd_token_lists(spark):
    topics = spark.createDataFrame([(0, "a", 1), (0, "b", 2)], "topic_id int, term string, rank int")
    odd = [(1, None), (2, []), (3, [None, "a"]), (3, ["a", "x", "b"]), (4, ["b", "a"] * 500)]
    schema = "doc_id int, tokens array<string>"
    for most in (99, 0):
        got = coherence.window_counts(spark.createDataFrame(odd, schema).repartition(3), topics, 2, most)
        assert rows(got) == [("a", "a", 1001, 1001, 1001, 1004), ("a", "b", 1001, 1000, 999, 1004), ("b", "b", 1000, 1000, 1000, 1004)]
        none = coherence.window_counts(spark.createDataFrame([], schema), topics, 2, most)
        assert {r[2:] for r in rows(none)} == {(0, 0, 0, None)}


def test_documents_are_read_once(spark, docs, tmp_path):
    """Words, unions and the number of windows come from one pass over the texts."""
    topics = spark.createDataFrame([(0, "a", 1), (0, "b", 2)], "topic_id int, term string, rank int")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    n = docs.count()
    seen = docs.select("doc_id", "tokens").mapInArrow(count, "doc_id int, tokens array<string>")
    coherence.window_counts(seen, topics, 5).collect()
    assert read.value == n


def test_coherence_prefers_words_that_meet(spark):
    data = [(i, ["a", "b", "c"] if i % 2 else ["x", "y", "z"]) for i in range(20)]
    docs = spark.createDataFrame(data, "doc_id int, tokens array<string>")
    topics = spark.createDataFrame(
        [(0, "a", 1), (0, "b", 2), (0, "c", 3), (1, "a", 1), (1, "x", 2), (1, "b", 3)], "topic_id int, term string, rank int"
    )
    good, bad = [r["coherence"] for r in coherence.c_v(docs, topics).orderBy("topic_id").collect()]
    assert good == pytest.approx(1.0) and bad < 0.9
    good, bad = [r["coherence"] for r in coherence.umass(docs, topics).orderBy("topic_id").collect()]
    assert good == pytest.approx(0.0, abs=1e-9) and bad < -5


def _counted(spark, docs):
    """The same documents, and how many rows of them were read."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    columns = "doc_id int, topic_id int, tokens array<string>"
    return docs.mapInArrow(count, columns), read


def test_vocabulary_and_number_of_documents_come_from_one_reading(spark, docs):
    seen, read = _counted(spark, docs)
    terms.vocabulary(seen).collect()
    assert read.value == len(DOCS)
    seen, read = _counted(spark, docs)
    terms.tfidf(seen).collect()
    assert read.value == 2 * len(DOCS)  # once for the vocabulary, once for the counts


def test_topic_samples_read_documents_once(spark, docs):
    seen, read = _counted(spark, docs)
    terms.topic_samples(terms.topic_keywords(seen, k=4)).collect()
    assert read.value == len(DOCS)


def test_documents_without_tokens_count(spark):
    rows_in = [(1, 0, ["a", "b"]), (2, 0, []), (3, 0, None), (4, 1, ["a", None, None]), (5, 1, ["b"]), (6, 2, [])]
    docs = spark.createDataFrame(rows_in, "doc_id int, topic_id int, tokens array<string>")
    assert rows(terms.vocabulary(docs, 1, 0.34)) == [(None, 1), ("a", 2), ("b", 2)]  # at most 2.04 of 6
    assert rows(terms.vocabulary(docs, 1, 0.33)) == [(None, 1)]
    sizes = terms.topic_keywords(docs, high=1).select("topic_id", "doc_count").distinct()
    assert rows(sizes) == [(0, 3), (1, 2)]  # class 2 has no word
    worded = docs.filter("size(tokens) > 0")
    assert rows(terms.doc_term_counts(worded)) == [(1, "a", 1), (1, "b", 1), (4, None, 2), (4, "a", 1), (5, "b", 1)]
