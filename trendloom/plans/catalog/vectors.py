"""Similarity to reference vectors. The references are the mean vectors of the labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from trendloom.operators import encoding, filters, neighbours, reports, vectors
from trendloom.plans import domain
from trendloom.plans.catalog.base import EXCLUDED, EXCLUDED_SQL, query, table

# One mean vector per label, then one mean over those.
_REFS_SQL = """refs AS (SELECT label, list(m ORDER BY i) AS ref FROM (
      SELECT label, i, avg(v) AS m FROM (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v,
        unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY label, i) GROUP BY label),
    centre AS (SELECT list(m ORDER BY i) AS ref FROM (SELECT i, avg(v) AS m FROM (
        SELECT unnest(ref) AS v, unnest(range(1, len(ref) + 1)) AS i FROM refs) GROUP BY i)),
    vecs AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"""
_MAX_SQL = f"""{_REFS_SQL}, scored AS (SELECT vec_id, max(CASE WHEN isnan(s) THEN 0 ELSE s END) AS s
    FROM (SELECT vec_id, list_cosine_similarity(e, ref) AS s FROM vecs, refs) GROUP BY vec_id)"""
_THRESHOLD = 0.2


def _references(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return vectors.centroid(rows, by=["label"])


def _scored(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.max_similarity(rows, _references(spark, sf_dir)).drop("embedding")


@query(f"WITH {_REFS_SQL} SELECT label, i, round(ref[i], 4) + 0.0 AS mean FROM (SELECT label, ref, unnest(range(1, len(ref) + 1)) AS i FROM refs)")
def centroid(spark, sf_dir):
    means = _references(spark, sf_dir).select("label", F.posexplode("embedding").alias("i", "mean"))
    return means.select("label", (F.col("i") + 1).cast("bigint").alias("i"), F.round("mean", 4).alias("mean"))


@query(f"WITH {_MAX_SQL} SELECT vec_id, round(s, 4) + 0.0 AS tech_similarity FROM scored")
def max_similarity(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return scored.withColumn("tech_similarity", F.round("tech_similarity", 4))


@query(
    f"""WITH {_REFS_SQL} SELECT vec_id, round(list_cosine_similarity(e, ref), 4) + 0.0 AS tech_similarity
    FROM vecs, centre"""
)
def centroid_similarity(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    scored = vectors.centroid_similarity(rows, _references(spark, sf_dir))
    return scored.select("vec_id", F.round("tech_similarity", 4).alias("tech_similarity"))


@query(
    f"""WITH {_REFS_SQL}, s AS (SELECT vec_id, label, round(list_cosine_similarity(e, ref), 6) + 0.0 AS s
      FROM (SELECT vec_id, e FROM vecs), refs),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS rn,
      avg(s) OVER (PARTITION BY vec_id) AS mean FROM s)
    SELECT vec_id, label AS ref, round(s, 4) + 0.0 AS score, round(mean, 4) + 0.0 AS mean_score FROM r WHERE rn = 1"""
)
def score_cross(spark, sf_dir):
    """All reference scores of a row in one array, reduced to the best and the mean."""
    refs = _references(spark, sf_dir).orderBy("label").collect()  # one row per label
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    scored = vectors.score_cross(rows, np.array([r["embedding"] for r in refs]), [r["label"] for r in refs])
    ranked = F.transform(
        "scores", lambda s: F.struct(F.round(s["score"], 6).alias("score"), (-s["ref"]).alias("neg"))
    )
    total = F.aggregate("scores", F.lit(0.0), lambda acc, s: acc + s["score"])
    return scored.select("vec_id", F.array_max(ranked).alias("b"), total.alias("t"), F.size("scores").alias("n")).select(
        "vec_id",
        (-F.col("b.neg")).alias("ref"),
        F.round("b.score", 4).alias("score"),
        F.round(F.col("t") / F.col("n"), 4).alias("mean_score"),
    )


@query(f"WITH {_MAX_SQL} SELECT vec_id FROM scored WHERE s >= {_THRESHOLD}")
def min_similarity(spark, sf_dir):
    return filters.min_similarity(_scored(spark, sf_dir), _THRESHOLD).select("vec_id")


_STATS_SQL = """count(*) AS n, round(avg(s), 4) + 0.0 AS mean, round(median(s), 4) + 0.0 AS median,
    round(min(s), 4) + 0.0 AS lowest, round(max(s), 4) + 0.0 AS highest"""


def _rounded(stats):
    return stats.select("n", *[F.round(c, 4).alias(c) for c in ("mean", "median", "lowest", "highest")])


@query(f"WITH {_MAX_SQL} SELECT {_STATS_SQL} FROM scored WHERE s >= {_THRESHOLD}")
def similarity_stats(spark, sf_dir):
    return _rounded(reports.similarity_stats(_scored(spark, sf_dir), threshold=_THRESHOLD))


@query(f"WITH {_MAX_SQL} SELECT {_STATS_SQL} FROM scored")
def similarity_stats_all(spark, sf_dir):
    return _rounded(reports.similarity_stats(_scored(spark, sf_dir), threshold=_THRESHOLD, population="all"))


@query(
    """WITH v AS (SELECT doc_id, n_chars, substring(text, 1, 80) AS preview FROM documents)
    SELECT 'top' AS side, * FROM (SELECT * FROM v ORDER BY n_chars DESC, doc_id LIMIT 5)
    UNION ALL SELECT 'bottom', * FROM (SELECT * FROM v ORDER BY n_chars, doc_id LIMIT 5)"""
)
def top_bottom(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    return reports.extremes(docs, "n_chars", "doc_id", 5, "text")


@query(
    """WITH s AS (SELECT label AS k, round(avg(CAST(embedding[1] AS DOUBLE)), 6) + 0.0 AS score
      FROM embeddings GROUP BY 1)
    SELECT k, score FROM s ORDER BY score DESC, k LIMIT 1"""
)
def best_k(spark, sf_dir):
    scores = (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.col("label").alias("k"))
        .agg(F.round(F.avg(F.get("embedding", F.lit(0)).cast("double")), 6).alias("score"))
    )
    return reports.best_k(scores)


def _encoded_sql(texts: str) -> str:
    """Unit vectors u (k, id, b, x) of texts (id, t), k = 'd', which fit the weights, and of the benchmark, k = 'r'."""
    return f"""texts AS (SELECT 'd' AS k, id, t FROM ({texts}) UNION ALL SELECT 'r', item_id, text FROM benchmark),
    tf AS (SELECT k, id, CAST(concat('0x', substring(md5(w), 1, 7)) AS BIGINT) % 512 AS b, count(*) AS n
        FROM (SELECT k, id, unnest(regexp_extract_all(lower(t), '[가-힣a-zA-Z0-9]{{2,}}')) AS w FROM texts) GROUP BY 1, 2, 3),
    nd AS (SELECT count(*) AS nd FROM texts WHERE k = 'd'),
    idf AS (SELECT b, ln((nd + 1) / (count(*) FILTER (k = 'd') + 1)) AS w FROM tf, nd GROUP BY b, nd),
    u AS (SELECT k, id, b, x / nullif(sqrt(sum(x * x) OVER (PARTITION BY k, id)), 0) AS x
        FROM (SELECT k, id, b, n * w AS x FROM tf JOIN idf USING (b)))"""


_POSTS_SQL = f"""{_encoded_sql("SELECT doc_id AS id, text AS t FROM documents")}, scored AS (
    SELECT doc_id, text, coalesce(s, 0) AS s FROM documents LEFT JOIN (SELECT id AS doc_id, max(s) AS s FROM (
        SELECT d.id, r.id AS item, sum(d.x * r.x) AS s FROM u d JOIN u r ON d.b = r.b WHERE d.k = 'd' AND r.k = 'r'
        GROUP BY 1, 2) GROUP BY 1) USING (doc_id))"""
_POST_THRESHOLD = 0.25


def _posts_and_sentences(spark, sf_dir):
    """All documents, the benchmark items as reference sentences, and the encoder of both."""
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    return docs, table(spark, sf_dir, "benchmark").select("text"), encoding.fit(docs)


@query(
    f"""WITH {_POSTS_SQL} SELECT doc_id, round(s, 4) + 0.0 AS tech_similarity
    FROM scored WHERE NOT ({EXCLUDED_SQL}) AND s >= {_POST_THRESHOLD}"""
)
def domain_filter_posts(spark, sf_dir):
    docs, sentences, encode = _posts_and_sentences(spark, sf_dir)
    kept = domain.domain_filter_posts(docs, sentences, EXCLUDED, _POST_THRESHOLD, encode=encode)
    return kept.select("doc_id", F.round("tech_similarity", 4).alias("tech_similarity"))


# A video is titled by its number and first turn.
_TITLES_SQL = """titles AS (SELECT conv_id, concat(CAST(conv_id AS VARCHAR), ' ', text) AS text
      FROM conversations WHERE turn = 0)"""
_CENTRE_SQL = f"""{_TITLES_SQL}, {_encoded_sql("SELECT conv_id AS id, text AS t FROM titles")},
    centre AS (SELECT b, x / sqrt(sum(x * x) OVER ()) AS x FROM (SELECT b, sum(x) AS x FROM u WHERE k = 'r' GROUP BY b)),
    scored AS (SELECT conv_id, text, coalesce(s, 0) AS s FROM titles LEFT JOIN (SELECT id AS conv_id, sum(u.x * c.x) AS s
        FROM u JOIN centre c USING (b) WHERE k = 'd' GROUP BY 1) USING (conv_id) WHERE NOT ({EXCLUDED_SQL}))"""
_VIDEO_THRESHOLD = 0.1


def _titled_rows(spark, sf_dir):
    """All rows with their titles, the titles, reference sentences, and the encoder of both."""
    rows = table(spark, sf_dir, "conversations")
    titles = rows.filter(F.col("turn") == 0).select(
        "conv_id", F.concat_ws(" ", F.col("conv_id").cast("string"), "text").alias("video_title")
    )
    sentences = table(spark, sf_dir, "benchmark").select("text")
    named = rows.join(titles, "conv_id").select("conv_id", "turn", "video_title")
    return named, titles.select("video_title"), sentences, encoding.fit(titles, "video_title")


def _video_scores(titles, sentences, encode):
    return domain.score_titles(titles, sentences, EXCLUDED, encode=encode)


@query(
    f"""WITH {_CENTRE_SQL} SELECT c.conv_id, turn, round(s, 4) + 0.0 AS tech_similarity
    FROM conversations c JOIN scored USING (conv_id) WHERE s >= {_VIDEO_THRESHOLD}"""
)
def domain_filter_videos(spark, sf_dir):
    rows, titles, sentences, encode = _titled_rows(spark, sf_dir)
    kept = domain.domain_filter_videos(
        rows, sentences, EXCLUDED, _VIDEO_THRESHOLD, titles, ["conv_id", "turn"], encode=encode
    )
    return kept.select("conv_id", "turn", F.round("tech_similarity", 4).alias("tech_similarity"))


@query(
    f"""WITH {_CENTRE_SQL} SELECT c.conv_id, turn FROM conversations c
    WHERE conv_id IN (SELECT conv_id FROM scored WHERE s >= {_VIDEO_THRESHOLD})"""
)
def keep_related(spark, sf_dir):
    rows, *scoring = _titled_rows(spark, sf_dir)
    accepted = filters.min_similarity(_video_scores(*scoring), _VIDEO_THRESHOLD)
    return domain.keep_related(rows, accepted).select("conv_id", "turn")


@query(
    f"""WITH {_CENTRE_SQL} SELECT c.conv_id, turn, round(s, 4) + 0.0 AS tech_similarity
    FROM conversations c LEFT JOIN scored USING (conv_id)"""
)
def attach_score(spark, sf_dir):
    rows, *scoring = _titled_rows(spark, sf_dir)
    scored = domain.attach_score(rows, _video_scores(*scoring))
    return scored.select("conv_id", "turn", F.round("tech_similarity", 4).alias("tech_similarity"))


@query(
    f"""WITH {_POSTS_SQL}, p AS (SELECT ({EXCLUDED_SQL}) AS bad, s FROM scored),
    c AS (SELECT count(*) AS c0, count(*) FILTER (WHERE NOT bad) AS c1,
        count(*) FILTER (WHERE NOT bad AND s >= {_POST_THRESHOLD}) AS c2 FROM p)
    SELECT 1 AS step_no, 'words' AS step, c0 AS "before", c0 - c1 AS removed, c1 AS "after",
      round(c1 * 100.0 / c0, 4) AS pct_kept FROM c
    UNION ALL SELECT 2, 'similarity', c1, c1 - c2, c2, round(c2 * 100.0 / c0, 4) FROM c"""
)
def domain_report_posts(spark, sf_dir):
    docs, sentences, encode = _posts_and_sentences(spark, sf_dir)
    report = domain.post_report(docs, sentences, EXCLUDED, _POST_THRESHOLD, encode=encode)
    return report.withColumn("pct_kept", F.round("pct_kept", 4))


@query(
    f"""WITH {_CENTRE_SQL}, n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1),
    m AS (SELECT n, s FROM n JOIN titles USING (conv_id) LEFT JOIN scored USING (conv_id))
    SELECT count(*) AS titles, count(s) AS clean_titles, count(*) FILTER (WHERE s >= {_VIDEO_THRESHOLD}) AS videos,
      CAST(sum(n) FILTER (WHERE s >= {_VIDEO_THRESHOLD}) AS BIGINT) AS "rows",
      round(sum(n) FILTER (WHERE s >= {_VIDEO_THRESHOLD}) / count(*) FILTER (WHERE s >= {_VIDEO_THRESHOLD}), 4) AS rows_per_video,
      round(count(*) FILTER (WHERE s >= {_VIDEO_THRESHOLD}) * 100.0 / count(*), 4) AS pct_kept FROM m"""
)
def domain_report_videos(spark, sf_dir):
    rows, titles, sentences, encode = _titled_rows(spark, sf_dir)
    report = domain.video_report(rows, sentences, EXCLUDED, _VIDEO_THRESHOLD, titles, encode=encode)
    return report.withColumns({c: F.round(c, 4) for c in ("rows_per_video", "pct_kept")})


# The vectors of the table lie far apart, so the radius is wide.
_RADIUS, _MIN_SAMPLES, _MIN_SIZE = 1.2, 8, 5
_NEAR_SQL = f"""unit AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
    near AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, list_dot_product(a.u, b.u) AS s FROM unit a, unit b
      WHERE list_dot_product(a.u, b.u) >= 1 - {_RADIUS} * {_RADIUS} / 2.0),
    counted AS (SELECT a AS vec_id, count(*) AS neighbours FROM near GROUP BY a)"""


@query(f"WITH {_NEAR_SQL} SELECT vec_id, neighbours FROM counted")
def neighbour_counts(spark, sf_dir):
    """How many vectors lie near each."""
    return neighbours.neighbour_counts(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64, _RADIUS)


@query(
    f"""WITH RECURSIVE {_NEAR_SQL},
    core AS (SELECT vec_id FROM counted WHERE neighbours >= {_MIN_SAMPLES}),
    links AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core)),
    reach(a, label) AS (SELECT vec_id, vec_id FROM core
      UNION SELECT links.b, reach.label FROM reach JOIN links ON links.a = reach.a),
    labels AS (SELECT a AS vec_id, min(label) AS cluster FROM reach GROUP BY a),
    edge AS (SELECT a AS vec_id, arg_min(cluster, (-round(s, 9), b)) AS cluster FROM near
      JOIN labels ON labels.vec_id = near.b WHERE a NOT IN (FROM core) GROUP BY a),
    named AS (SELECT * FROM labels UNION ALL SELECT * FROM edge),
    large AS (SELECT cluster FROM named GROUP BY cluster HAVING count(*) >= {_MIN_SIZE})
    SELECT vec_id, neighbours, neighbours >= {_MIN_SAMPLES} AS core,
      CASE WHEN cluster IN (FROM large) THEN cluster END AS cluster
    FROM counted LEFT JOIN named USING (vec_id)"""
)
def density_clusters(spark, sf_dir):
    """Clusters of any shape among the vectors, by links between neighbours."""
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.density_clusters(
        rows, radius=_RADIUS, min_samples=_MIN_SAMPLES, min_cluster_size=_MIN_SIZE
    )


@query(
    """WITH vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT a.vec_id, round(max(list_cosine_similarity(a.e, list_reverse(b.e))), 4) + 0.0 AS tech_similarity
    FROM vecs a, vecs b GROUP BY a.vec_id"""
)
def max_similarity_table(spark, sf_dir):
    """The best of as many references as there are vectors: the vectors read backwards."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    references = rows.select(F.reverse("embedding").alias("embedding"))
    scored = neighbours.max_cosine(rows, references, "embedding", "tech_similarity", block=256)
    return scored.select("vec_id", F.round("tech_similarity", 4).alias("tech_similarity"))
