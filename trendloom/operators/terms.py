"""Term statistics: vocabulary, TF-IDF, class TF-IDF and top words.

All of it is relational over long tables. The input is (doc_id, tokens array); text is
tokenised by the functions in trendloom.functions.text or by a user's tagger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom import session
from trendloom.functions import text as tx
from trendloom.operators import skew

_TAGGED = T.ArrayType(
    T.StructType([T.StructField("form", T.StringType()), T.StructField("tag", T.StringType())])
)


def tagger(load: Callable[[], Callable[[str], list[tuple[str, str]]]]):
    """A user's word tagger as a column function giving array<struct<form,tag>>.

    ``load`` builds the tagger, with any words added to it, once per Python worker.
    """

    @F.pandas_udf(_TAGGED)
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = load()
        for texts in batches:
            yield texts.fillna("").map(lambda t: [{"form": f, "tag": g} for f, g in run(t)])

    return tag


def tokenise(
    df: DataFrame,
    column: str = "text",
    out: str = "tokens",
    stop: Sequence[str] = (),
    lower: bool = False,
    with_tagger: Callable[[Column], Column] | None = None,
    tags: Sequence[str] = (),
    prefixes: Sequence[str] = ("N",),
    keep_empty: bool = False,
) -> DataFrame:
    """Add the token array; rows without any token are dropped, unless ``keep_empty`` asks for them.

    With a tagger, forms whose tag is listed or starts with a prefix are kept; without one,
    runs of two or more letters or digits.
    """
    text = F.lower(F.col(column)) if lower else F.col(column)
    if with_tagger is None:
        raw = tx.tokens(text)
    else:
        raw = tx.keep_tags(with_tagger(text), tags, prefixes)
    kept = tx.drop_stopwords(raw, stop) if stop or with_tagger else raw
    if keep_empty:
        return tx.with_once(df, out, F.coalesce(kept, F.array().cast("array<string>")))
    return tx.with_once(df, out, kept, lambda tokens: F.size(tokens) > 0)


def term_counts(
    docs: DataFrame, by: Sequence[str], tokens: str | Column = "tokens"
) -> DataFrame:
    """(by..., term, tf). Words are counted inside each task before anything is shuffled."""
    exploded = docs.select(*by, F.explode(tokens).alias("term"))
    return exploded.groupBy(*by, "term").agg(F.count("*").alias("tf"))


def doc_term_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, term, tf) where a document is one row: counted in the row, without a shuffle.

    In sorted tokens a word's repeats are neighbours, so its count is the distance from its
    first place to the next word's.
    """
    # sort_array compares strings as such, array_sort by a lambda; nulls come last in both.
    in_order = F.sort_array("tokens", asc=False)
    ordered = tx.with_once(docs.select("doc_id", "tokens"), "_s", in_order).drop("tokens")
    new = F.transform("_s", lambda here, i: F.when(~here.eqNullSafe(F.get("_s", i - 1)), i))
    places = F.filter(new, lambda i: i.isNotNull())
    placed = tx.with_once(ordered, "_at", places)
    ends = F.concat(F.slice("_at", F.lit(2), F.size("_at") - 1), F.array(F.size("_s")))
    counted = F.zip_with(
        "_at",
        ends,
        lambda at, end: F.struct(F.get("_s", at).alias("term"), (end - at).cast("bigint").alias("tf")),
    )
    return placed.select("doc_id", F.inline(counted))


def _first_place() -> Column:
    """1 on one row of each document, also on that of a document without a token."""
    return F.when(F.coalesce("_pos", F.lit(0)) == 0, 1)


def _document_counts(docs: DataFrame) -> tuple[DataFrame, Column]:
    """(term, df) of all terms, written, and the number of documents, from one reading of the text."""
    placed = docs.select(F.posexplode_outer(F.array_distinct("tokens")).alias("_pos", "term"))
    counts = session.cut_lineage(
        placed.groupBy("term").agg(F.count("_pos").alias("df"), F.count(_first_place()).alias("_docs"))
    )
    n = counts.agg(F.coalesce(F.sum("_docs"), F.lit(0))).scalar()
    return counts.filter("df > 0").select("term", "df"), n


def vocabulary(docs: DataFrame, min_df: int = 2, max_df: float = 0.8) -> DataFrame:
    """(term, df) of the terms found in at least min_df documents and at most a share max_df."""
    counts, n = _document_counts(docs)
    return counts.filter(_in_vocabulary(n, min_df, max_df))


def _in_vocabulary(n: Column, min_df: int, max_df: float) -> Column:
    return (F.col("df") >= min_df) & (F.col("df") <= n * F.lit(max_df))


def tfidf(
    docs: DataFrame, min_df: int = 2, max_df: float = 0.8, broadcast_rows: int = 2_000_000
) -> DataFrame:
    """(doc_id, term, weight): tf * (ln((1+n)/(1+df)) + 1), each document of length 1.

    The vocabulary is written first. Up to ``broadcast_rows`` terms it is broadcast, and the
    counts are then shuffled once, by document, for their length; a larger one is joined
    with salted keys, as the most common terms appear in most documents.
    """
    counts, n = _document_counts(docs)
    idf = F.log((n + 1) / (F.col("df") + 1)) + 1.0
    terms = counts.filter(_in_vocabulary(n, min_df, max_df)).select("term", idf.alias("idf"))
    weighted = skew.lookup(
        doc_term_counts(docs), terms, ["term"], ["doc_id"], "inner", max_rows=broadcast_rows
    ).select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return weighted.select("doc_id", "term", (F.col("w") / length).alias("weight"))


def class_tfidf(
    docs: DataFrame,
    label: str = "topic_id",
    tokens: str = "tokens",
    low: int = 1,
    high: int = 2,
) -> DataFrame:
    """(label, term, tf, score): tf share in the class * ln(1 + A / f).

    f is the count of the term over all classes, A the whole part of the mean word count of
    a class. Noise documents take part as a class of their own.
    """
    return _class_tfidf(_class_counts(docs, label, tokens, low, high), label)


def _class_counts(docs: DataFrame, label: str, tokens: str, low: int, high: int) -> DataFrame:
    """(label, term, tf, _docs), written: ``_docs`` adds up to the documents of a class.

    A class has a row with tf 0 for its documents without a term.
    """
    grams = tx.ngrams(F.col(tokens), low, high)
    placed = docs.select(label, F.posexplode_outer(grams).alias("_pos", "term"))
    # Far smaller than the text and used several times: written once.
    return session.cut_lineage(
        placed.groupBy(label, "term").agg(
            F.count("_pos").alias("tf"), F.count(_first_place()).alias("_docs")
        )
    )


def _class_tfidf(class_counts: DataFrame, label: str) -> DataFrame:
    counts = class_counts.filter("tf > 0").drop("_docs")
    totals = counts.groupBy(label).agg(F.sum("tf").alias("words"))
    average = totals.agg(F.floor(F.avg("words"))).scalar()
    everywhere = F.sum("tf").over(Window.partitionBy("term"))  # one row per class and term
    with_f = counts.withColumn("f", everywhere)
    joined = skew.lookup(with_f, totals, [label], ["term"], "inner", max_rows=1_000_000)
    score = F.col("tf") / F.col("words") * F.log(average / F.col("f") + 1)
    return joined.select(label, "term", "tf", score.alias("score"))


def top_terms(
    weights: DataFrame, k: int = 10, by: str = "topic_id", weight: str = "score"
) -> DataFrame:
    """The k heaviest terms per class with their rank; alphabetical on a tie."""
    order = [F.col(weight).desc(), F.col("term").asc()]
    return skew.first_n(weights, [by], order, k, rank="rank")


def topic_keywords(
    docs: DataFrame,
    label: str = "topic_id",
    k: int = 10,
    noise: int = -1,
    tokens: str = "tokens",
    high: int = 2,
) -> DataFrame:
    """(topic_id, topic_name, doc_count, keyword, score): the words that mark each topic."""
    counts = _class_counts(docs, label, tokens, 1, high)
    ranked = top_terms(_class_tfidf(counts, label), k, label).filter(F.col(label) != noise)
    sizes = counts.groupBy(label).agg(F.sum("_docs").alias("doc_count"))
    # k rows per topic: the window sees a handful of rows.
    whole = Window.partitionBy(label)
    first = F.array_sort(
        F.collect_list(F.when(F.col("rank") <= 3, F.struct("rank", "term"))).over(whole)
    )
    named = ranked.withColumn(
        "topic_name", F.array_join(F.transform(first, lambda s: s["term"]), " | ")
    )
    return named.join(sizes, label).select(
        F.col(label).alias("topic_id"),
        "topic_name",
        "doc_count",
        F.col("term").alias("keyword"),
        F.round("score", 4).alias("score"),
        "rank",
    )


def cluster_keywords(
    docs: DataFrame,
    label: str = "cluster",
    tokens: str = "tokens",
    order: str = "doc_id",
    pool: int = 10,
    k: int = 5,
    emit: str = "first_seen",
) -> DataFrame:
    """(keyword, cluster): frequent words per cluster; clusters count from 1.

    The ``pool`` most frequent words of a cluster are kept and ``k`` of them emitted: those
    seen first in the cluster's text, or the most frequent ones with emit='frequency'.
    """
    lowered = F.transform(tokens, lambda t: F.lower(t))
    exploded = docs.select(
        label, F.col(order).alias("_at"), F.posexplode(lowered).alias("_pos", "term")
    )
    counts = exploded.groupBy(label, "term").agg(
        F.count("*").alias("tf"), F.min(F.struct("_at", "_pos")).alias("seen")
    )
    frequent = top_terms(counts, pool, label, "tf")
    by = F.col("seen") if emit == "first_seen" else F.col("rank")
    window = Window.partitionBy(label).orderBy(by)  # at most ``pool`` rows
    return (
        frequent.withColumn("place", F.row_number().over(window))
        .filter(F.col("place") <= k)
        .select(F.col("term").alias("keyword"), (F.col(label) + 1).cast("int").alias("cluster"), "place", "tf")
    )


def topic_samples(keywords: DataFrame, topics: int = 3, words: int = 10) -> DataFrame:
    """(topic_id, topic_name, doc_count, keywords) of the first topics."""
    keywords = session.cut_lineage(keywords)  # a few rows per topic, used twice
    first = keywords.select("topic_id").distinct().orderBy("topic_id").limit(topics)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "keyword")))
    return (
        keywords.filter(F.col("rank") <= words)
        .join(F.broadcast(first), "topic_id")  # ``topics`` rows
        .groupBy("topic_id", "topic_name", "doc_count")
        .agg(F.array_join(F.transform(ordered, lambda s: s["keyword"]), ", ").alias("keywords"))
    )
