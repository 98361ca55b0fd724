"""Term statistics, class TF-IDF and coherence over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendloom.functions import text as tx
from trendloom.operators import coherence, filters, reports, terms
from trendloom.plans.catalog.base import query, table

_STOP = ("the", "of", "and", "de", "la", "der", "die")
_STOP_SQL = ", ".join(f"'{w}'" for w in _STOP)
_TOKENS_SQL = f"""toks AS (SELECT * FROM (SELECT doc_id, source, lang,
      [w FOR w IN regexp_extract_all(lower(text), '[가-힣a-zA-Z0-9]{{2,}}')
         IF w NOT IN ({_STOP_SQL})] AS tokens FROM documents) WHERE len(tokens) > 0)"""
_COUNTS_SQL = f"""{_TOKENS_SQL}, tf AS (SELECT doc_id, term, count(*) AS tf FROM (
      SELECT doc_id, unnest(tokens) AS term FROM toks) GROUP BY 1, 2),
    n AS (SELECT count(*) AS n FROM toks),
    vocab AS (SELECT term, count(*) AS df FROM tf GROUP BY term
      HAVING count(*) >= 2 AND count(*) <= (SELECT n FROM n) * 0.8)"""


def _docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "source", "lang", "text")
    return terms.tokenise(docs, stop=_STOP, lower=True).drop("text")


@query(
    f"""WITH {_TOKENS_SQL} SELECT doc_id, len(tokens) AS n_tokens, tokens[1] AS first_token,
      md5(array_to_string(tokens, ' ')) AS tokens_md5 FROM toks"""
)
def tokenise(spark, sf_dir):
    return _docs(spark, sf_dir).select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.get("tokens", F.lit(0)).alias("first_token"),
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
    )


@query(
    """WITH w AS (SELECT conv_id, turn, [x FOR x IN string_split_regex(text, '\\s+') IF x <> ''] AS w
      FROM conversations)
    SELECT conv_id, turn, len(w) AS n_words, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))][1]
      AS first_bigram, greatest(len(w) - 1, 0) AS n_bigrams FROM w"""
)
def ngrams(spark, sf_dir):
    words = table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.words(F.col("text")).alias("w"))
    pairs = tx.ngrams(F.col("w"), 2, 2)
    return words.select(
        "conv_id",
        "turn",
        F.size("w").cast("bigint").alias("n_words"),
        F.get(pairs, F.lit(0)).alias("first_bigram"),
        F.size(pairs).cast("bigint").alias("n_bigrams"),
    )


@query(f"WITH {_COUNTS_SQL} SELECT term, df FROM vocab")
def vocabulary(spark, sf_dir):
    return terms.vocabulary(_docs(spark, sf_dir))


@query(
    f"""WITH {_COUNTS_SQL}, w AS (SELECT doc_id, term, tf * (ln((1.0 + n) / (1 + df)) + 1) AS w
      FROM tf JOIN vocab USING (term), n)
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 4) + 0.0 AS weight FROM w"""
)
def tfidf(spark, sf_dir):
    weights = terms.tfidf(_docs(spark, sf_dir))
    return weights.withColumn("weight", F.round("weight", 4))


def _class_sql(label: str, table_sql: str, grams: str) -> str:
    return f"""{table_sql},
    ct AS (SELECT label, term, count(*) AS tf FROM (
        SELECT {label} AS label, unnest({grams}) AS term FROM toks) GROUP BY 1, 2),
    tot AS (SELECT label, sum(tf) AS words FROM ct GROUP BY 1),
    f AS (SELECT term, sum(tf) AS f FROM ct GROUP BY 1),
    a AS (SELECT floor(avg(words)) AS a FROM tot),
    cs AS (SELECT label, term, tf, tf / words * ln(a / f + 1) AS score
        FROM ct JOIN tot USING (label) JOIN f USING (term), a)"""


_UNI_SQL = _class_sql("source", _TOKENS_SQL, "tokens")
_BIGRAMS = "list_concat(tokens, [tokens[i] || ' ' || tokens[i + 1] FOR i IN range(1, len(tokens))])"


@query(f"WITH {_UNI_SQL} SELECT label AS source, term, tf, round(score, 8) + 0.0 AS score FROM cs")
def class_tfidf(spark, sf_dir):
    scores = terms.class_tfidf(_docs(spark, sf_dir), "source", high=1)
    return scores.withColumn("score", F.round("score", 8))


@query(
    f"""WITH {_UNI_SQL}, r AS (SELECT label AS source, term, tf,
        row_number() OVER (PARTITION BY label ORDER BY tf DESC, term) AS rank FROM cs)
    SELECT * FROM r WHERE rank <= 10"""
)
def top_terms(spark, sf_dir):
    counts = terms.term_counts(_docs(spark, sf_dir), ["source"])
    return terms.top_terms(counts, 10, "source", "tf")


# Topics of a document: the label of its vector; label 0 plays the part of noise, and so do
# documents without a vector.
_LABELLED_SQL = f"""{_TOKENS_SQL.replace("toks AS", "all_toks AS")},
    toks AS (SELECT doc_id, tokens, coalesce(label - 1, -1) AS topic_id FROM all_toks LEFT JOIN embeddings ON doc_id = vec_id)"""


def _labelled(spark, sf_dir):
    labels = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), (F.col("label") - 1).alias("topic_id")
    )
    return _docs(spark, sf_dir).join(labels, "doc_id", "left").fillna(-1, ["topic_id"])


_TOPICS_SQL = f"""{_class_sql("topic_id", _LABELLED_SQL, _BIGRAMS)},
    r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, term) AS rank FROM cs),
    names AS (SELECT label, string_agg(term, ' | ' ORDER BY rank) AS topic_name FROM r
        WHERE rank <= 3 GROUP BY label),
    sizes AS (SELECT topic_id AS label, count(*) AS doc_count FROM toks GROUP BY 1),
    words AS (SELECT label AS topic_id, topic_name, doc_count, term AS keyword, round(score, 4) + 0.0 AS score,
        rank FROM r JOIN names USING (label) JOIN sizes USING (label) WHERE rank <= 10 AND label <> -1)"""


@query(f"WITH {_TOPICS_SQL} SELECT * FROM words")
def topic_keywords(spark, sf_dir):
    return terms.topic_keywords(_labelled(spark, sf_dir))


@query(
    f"""WITH {_TOPICS_SQL} SELECT topic_id, topic_name, doc_count,
      string_agg(keyword, ', ' ORDER BY rank) AS keywords FROM words
    WHERE topic_id IN (SELECT DISTINCT topic_id FROM words ORDER BY topic_id LIMIT 3)
    GROUP BY 1, 2, 3"""
)
def topic_samples(spark, sf_dir):
    return terms.topic_samples(terms.topic_keywords(_labelled(spark, sf_dir)))


_CLUSTER_SQL = f"""{_LABELLED_SQL},
    e AS (SELECT topic_id, doc_id, unnest(tokens) AS term, unnest(range(0, len(tokens))) AS p FROM toks),
    c AS (SELECT topic_id, term, count(*) AS tf, min(doc_id * 1000000 + p) AS seen FROM e GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY tf DESC, term) AS rn FROM c)"""


@query(
    f"""WITH {_CLUSTER_SQL}, s AS (SELECT term AS keyword, topic_id + 1 AS cluster,
        row_number() OVER (PARTITION BY topic_id ORDER BY seen) AS place, tf FROM r WHERE rn <= 10)
    SELECT * FROM s WHERE place <= 5"""
)
def cluster_keywords(spark, sf_dir):
    return terms.cluster_keywords(_labelled(spark, sf_dir), "topic_id")


@query(
    f"""WITH {_CLUSTER_SQL} SELECT term AS keyword, topic_id + 1 AS cluster, rn AS place, tf
    FROM r WHERE rn <= 5"""
)
def cluster_keywords_by_frequency(spark, sf_dir):
    return terms.cluster_keywords(_labelled(spark, sf_dir), "topic_id", emit="frequency")


@query("SELECT label AS topic_id, count(*) AS doc_count FROM embeddings GROUP BY 1")
def cluster_sizes(spark, sf_dir):
    return reports.cluster_sizes(
        table(spark, sf_dir, "embeddings").select(F.col("label").alias("topic_id"))
    )


@query(
    """WITH s AS (SELECT label - 1 AS t, count(*) AS n FROM embeddings GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS docs, count(*) FILTER (WHERE t <> -1) AS topics,
      CAST(coalesce(sum(n) FILTER (WHERE t = -1), 0) AS BIGINT) AS noise_docs,
      round(avg(n) FILTER (WHERE t <> -1), 4) + 0.0 AS mean_size, max(n) FILTER (WHERE t <> -1) AS max_size,
      min(n) FILTER (WHERE t <> -1) AS min_size,
      round(coalesce(sum(n) FILTER (WHERE t = -1), 0) * 100.0 / sum(n), 4) + 0.0 AS noise_pct FROM s"""
)
def topic_size_stats(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select((F.col("label") - 1).alias("topic_id"))
    stats = reports.topic_size_stats(rows)
    return stats.withColumns({c: F.round(c, 4) for c in ("mean_size", "noise_pct")})


@query("SELECT label - 1 AS topic_id, vec_id FROM embeddings WHERE label <> 0")
def drop_noise_topic(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select((F.col("label") - 1).alias("topic_id"), "vec_id")
    return filters.drop_noise_topic(rows)


# Coherence of the five most frequent longer words per language, over windows of 30 tokens.
_SIZE = 30
_TOP_SQL = f"""{_TOKENS_SQL},
    lt AS (SELECT lang, term, count(*) AS tf FROM (SELECT lang, unnest(tokens) AS term FROM toks)
        WHERE length(term) >= 4 GROUP BY 1, 2),
    top AS (SELECT lang AS topic_id, term, rank FROM (SELECT lang, term, row_number() OVER (
        PARTITION BY lang ORDER BY tf DESC, term) AS rank FROM lt) WHERE rank <= 5)"""
_WINDOWS_SQL = f"""{_TOP_SQL},
    lens AS (SELECT doc_id, greatest(1, len(tokens) - {_SIZE} + 1) AS w FROM toks),
    occ AS (SELECT DISTINCT doc_id, term, p FROM (SELECT doc_id, unnest(tokens) AS term,
        unnest(range(0, len(tokens))) AS p FROM toks) WHERE term IN (SELECT term FROM top)),
    hit AS (SELECT DISTINCT doc_id, term, start FROM (SELECT o.doc_id, term,
        unnest(range(greatest(0, p - {_SIZE} + 1), least(p, w - 1) + 1)) AS start
        FROM occ o JOIN lens l ON o.doc_id = l.doc_id)),
    single AS (SELECT term, count(*) AS c FROM hit GROUP BY 1),
    pairs AS (SELECT DISTINCT x.topic_id, x.term AS a, y.term AS b FROM top x JOIN top y
        ON x.topic_id = y.topic_id),
    both_ AS (SELECT x.term AS a, y.term AS b, count(*) AS c FROM hit x JOIN hit y
        ON x.doc_id = y.doc_id AND x.start = y.start GROUP BY 1, 2),
    total AS (SELECT sum(w) AS n FROM lens),
    counted AS (SELECT topic_id, p.a, p.b, sa.c AS n_a, sb.c AS n_b, coalesce(bo.c, 0) AS n_ab,
        CAST(n AS BIGINT) AS n FROM pairs p JOIN single sa ON sa.term = p.a JOIN single sb ON sb.term = p.b
        LEFT JOIN both_ bo ON bo.a = p.a AND bo.b = p.b, total),
    scored AS (SELECT *, ln((n_ab / n + 1e-12) / ((n_a / n) * (n_b / n))) / -ln(n_ab / n + 1e-12) AS npmi
        FROM counted)"""


def _top_words(docs):
    long = docs.select("lang", F.filter("tokens", lambda t: F.length(t) >= 4).alias("tokens"))
    top = terms.top_terms(terms.term_counts(long, ["lang"]), 5, "lang", "tf")
    return top.select(F.col("lang").alias("topic_id"), "term", "rank")


@query(
    f"""WITH {_WINDOWS_SQL} SELECT DISTINCT a, b, n_a, n_b, n_ab, n, round(npmi, 4) + 0.0 AS npmi
    FROM scored WHERE a <= b"""
)
def npmi(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    scores = coherence.npmi(coherence.window_counts(docs, _top_words(docs), _SIZE))
    return scores.withColumn("npmi", F.round("npmi", 4))


@query(
    f"""WITH {_WINDOWS_SQL},
    s AS (SELECT topic_id, b, sum(npmi) AS s FROM scored GROUP BY 1, 2),
    c AS (SELECT x.topic_id, a, sum(npmi * s) / (sqrt(sum(npmi * npmi)) * sqrt(sum(s * s))) AS c
        FROM scored x JOIN s ON x.topic_id = s.topic_id AND x.b = s.b GROUP BY 1, 2)
    SELECT topic_id, round(avg(c), 4) + 0.0 AS coherence FROM c GROUP BY 1"""
)
def coherence_c_v(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    per_topic = coherence.c_v(docs, _top_words(docs), _SIZE)
    return per_topic.withColumn("coherence", F.round("coherence", 4))


@query(
    f"""WITH {_TOP_SQL}, has AS (SELECT DISTINCT doc_id, term FROM (
        SELECT doc_id, unnest(tokens) AS term FROM toks) WHERE term IN (SELECT term FROM top)),
    n AS (SELECT count(*) AS n FROM toks),
    p AS (SELECT x.topic_id, x.term AS a, y.term AS b FROM top x JOIN top y
        ON x.topic_id = y.topic_id AND y.rank < x.rank),
    s AS (SELECT topic_id, ln(((SELECT count(*) FROM has h JOIN has g ON h.doc_id = g.doc_id
          WHERE h.term = p.a AND g.term = p.b) / n + 1e-12)
        / ((SELECT count(*) FROM has h WHERE h.term = p.b) / n)) AS s FROM p, n)
    SELECT topic_id, round(avg(s), 4) + 0.0 AS coherence FROM s GROUP BY 1"""
)
def coherence_umass(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    per_topic = coherence.umass(docs, _top_words(docs))
    return per_topic.withColumn("coherence", F.round("coherence", 4))
