"""Merging, filtering, limiting and keyword queries over posts."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendloom import schemas
from trendloom.functions import text as tx
from trendloom.operators import dedup, filters, keywords, reports, terms
from trendloom.plans import merge
from trendloom.plans.catalog.base import (
    EXCLUDED,
    EXCLUDED_SQL,
    THEMES,
    VIDEO_ROWS_SQL,
    posts,
    query,
    table,
    video_rows,
)

_UNION_SQL = """
    SELECT 'a' AS file_name, doc_id AS row_no, text, source AS search_query,
           CAST(NULL AS VARCHAR) AS author_id FROM documents
    UNION ALL
    SELECT 'b', conv_id * 1000 + turn, text, NULL, role FROM conversations"""


def _two_dumps(spark, sf_dir):
    first = table(spark, sf_dir, "documents").select(
        F.lit("a").alias("file_name"),
        F.col("doc_id").alias("row_no"),
        "text",
        F.col("source").alias("search_query"),
    )
    second = table(spark, sf_dir, "conversations").select(
        F.lit("b").alias("file_name"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_no"),
        "text",
        F.col("role").alias("author_id"),
    )
    return [first, second]


@query(
    f"""WITH u AS ({_UNION_SQL}),
    r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY file_name, row_no) AS rn FROM u)
    SELECT file_name, row_no, search_query, author_id, md5(text) AS text_md5,
           length(text) AS n_chars
    FROM r WHERE rn = 1 AND NOT ({EXCLUDED_SQL})"""
)
def merge_posts(spark, sf_dir):
    merged = merge.merge_posts(_two_dumps(spark, sf_dir), ["file_name", "row_no"])
    kept = filters.drop_excluded(merged, "text", EXCLUDED)
    return kept.select(
        "file_name",
        "row_no",
        "search_query",
        "author_id",
        F.md5("text").alias("text_md5"),
        F.length("text").cast("bigint").alias("n_chars"),
    )


@query(
    """SELECT DISTINCT conv_id, turn, role, md5(text) AS text_md5 FROM
    (SELECT * FROM conversations UNION ALL SELECT * FROM conversations)"""
)
def merge_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return merge.merge_rows([rows, rows]).select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query(
    f"""WITH u AS ({_UNION_SQL}), k AS (SELECT text, count(*) AS n FROM u GROUP BY text)
    SELECT CAST(sum(n) AS BIGINT) AS "before", CAST(sum(n - 1) AS BIGINT) AS removed,
           count(*) AS "after" FROM k"""
)
def dedup_counts(spark, sf_dir):
    return reports.dedup_counts(dedup.union_by_name(_two_dumps(spark, sf_dir)), ["text"])


@query(
    """SELECT seq, search_query FROM (
      SELECT doc_id AS seq, source AS search_query, row_number() OVER (
        PARTITION BY source, substring(text, 1, 50) ORDER BY doc_id) AS rn FROM documents)
    WHERE rn = 1"""
)
def dedup_prefix(spark, sf_dir):
    unique = dedup.dedup_prefix(posts(spark, sf_dir), "text", "search_query", ["seq"])
    return unique.select("seq", "search_query")


@query(
    f"""WITH c AS (SELECT doc_id AS seq, source AS search_query, text,
        row_number() OVER (PARTITION BY source, substring(text, 1, 50) ORDER BY doc_id) AS p
        FROM documents WHERE NOT ({EXCLUDED_SQL})),
    r AS (SELECT seq, search_query,
        row_number() OVER (PARTITION BY search_query ORDER BY seq) AS rank FROM c WHERE p = 1)
    SELECT * FROM r WHERE rank <= 20"""
)
def limit_per_query(spark, sf_dir):
    out = keywords.limit_per_query(posts(spark, sf_dir), 20, EXCLUDED)
    return out.select("seq", "search_query", "rank")


@query(
    f"""WITH c AS (SELECT source AS search_query, substring(text, 1, 50) AS p, count(*) AS n,
        count(*) FILTER (WHERE NOT ({EXCLUDED_SQL})) AS c FROM documents GROUP BY 1, 2)
    SELECT search_query, CAST(sum(n) AS BIGINT) AS scanned, count(*) FILTER (WHERE c > 0) AS kept,
      CAST(sum(n - c) AS BIGINT) AS noise,
      CAST(sum(CASE WHEN c > 0 THEN c - 1 ELSE 0 END) AS BIGINT) AS repeated
    FROM c GROUP BY search_query"""
)
def scan_report(spark, sf_dir):
    return keywords.scan_report(posts(spark, sf_dir), EXCLUDED)


@query(
    f"""WITH v AS ({VIDEO_ROWS_SQL}),
    u AS (SELECT *, row_number() OVER (PARTITION BY video_url, type, author, comment ORDER BY seq)
          AS d FROM v WHERE type = 'description' OR length(comment) >= 120),
    r AS (SELECT conv_id, seq, type, row_number() OVER (PARTITION BY video_url ORDER BY
          CASE WHEN type = 'description' THEN 0 ELSE 1 END, seq) AS rank FROM u WHERE d = 1)
    SELECT * FROM r WHERE rank <= 4"""
)
def comments_limit(spark, sf_dir):
    out = keywords.comments_limit(video_rows(spark, sf_dir), 3, 120)
    return out.select("conv_id", "seq", "type", "rank")


_LINKS_SQL = """SELECT p_partkey AS seq, p_brand AS search_keyword,
    concat(CASE WHEN p_size % 5 = 0 THEN '/shorts/' ELSE '/watch?v=' END,
           CAST(p_partkey AS VARCHAR)) AS url FROM part"""


def _links(spark, sf_dir):
    start = F.when(F.col("p_size") % 5 == 0, "/shorts/").otherwise("/watch?v=")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seq"),
        F.col("p_brand").alias("search_keyword"),
        F.concat(start, F.col("p_partkey").cast("string")).alias("url"),
    )


@query(f"SELECT * FROM ({_LINKS_SQL}) WHERE contains(url, '/watch?v=')")
def watch_links(spark, sf_dir):
    return filters.watch_links(_links(spark, sf_dir))


@query(
    f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY search_keyword ORDER BY seq)
      AS rank FROM ({_LINKS_SQL}) WHERE contains(url, '/watch?v=')) WHERE rank <= 10"""
)
def videos_per_keyword(spark, sf_dir):
    return keywords.videos_per_keyword(_links(spark, sf_dir))


@query("SELECT DISTINCT title FROM (SELECT unnest(string_split(text, chr(10))) AS title FROM documents) WHERE title <> ''")
def distinct_titles(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("title"))
    return dedup.distinct_values(lines, "title")


@query(
    """WITH t AS (SELECT source, unnest(regexp_extract_all(text, '[가-힣a-zA-Z0-9]{2,}')) AS term
      FROM documents),
    c AS (SELECT source, term, count(*) AS tf FROM t GROUP BY 1, 2),
    r AS (SELECT term, row_number() OVER (PARTITION BY source ORDER BY tf DESC, term) AS rn FROM c)
    SELECT DISTINCT term AS keyword FROM r WHERE rn <= 10"""
)
def keyword_union(spark, sf_dir):
    docs = terms.tokenise(table(spark, sf_dir, "documents", spread=True))
    counts = terms.term_counts(docs, ["source"])
    return dedup.keyword_union(terms.top_terms(counts, 10, "source", "tf"), "term")


@query(f"SELECT doc_id FROM documents WHERE NOT ({EXCLUDED_SQL})")
def drop_excluded(spark, sf_dir):
    return filters.drop_excluded(table(spark, sf_dir, "documents"), "text", EXCLUDED).select("doc_id")


@query(
    """SELECT conv_id, turn FROM conversations WHERE NOT (contains(lower(text), 'idiot') OR
      contains(lower(text), 'free') OR contains(lower(text), 'the '))"""
)
def is_clean(spark, sf_dir):
    rows = filters.is_clean(table(spark, sf_dir, "conversations"), "text", ["idiot", "FREE", "the "])
    return rows.select("conv_id", "turn")


@query(
    " UNION ALL ".join(
        f"SELECT '{theme}' AS theme, count(*) AS hits FROM documents WHERE "
        + " OR ".join(f"contains(lower(text), '{w.lower()}')" for w in words)
        for theme, words in THEMES.items()
    )
)
def noise_hits(spark, sf_dir):
    return filters.noise_hits(table(spark, sf_dir, "documents", spread=True), "text", THEMES)


_TITLE_SQL = "regexp_extract(html, '<title>(.*?)</title>', 1)"
_SIGNS = (*filters.NOISE_SIGNS, "%", "*", "#")


def _titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title")
    )


@query(
    f"""SELECT page_id, {_TITLE_SQL} AS title FROM pages WHERE length({_TITLE_SQL}) >= 2
      AND NOT ({" OR ".join(f"contains({_TITLE_SQL}, '{s * 3}')" for s in _SIGNS)})"""
)
def noise_titles_loose(spark, sf_dir):
    return filters.noise_titles(_titles(spark, sf_dir), "title", "loose", _SIGNS)


@query(
    f"""SELECT page_id, {_TITLE_SQL} AS title FROM pages WHERE length({_TITLE_SQL}) >= 5
      AND translate({_TITLE_SQL}, ' ㅋㅎㄷㅇ', '') <> ''
      AND NOT ({" OR ".join(f"contains({_TITLE_SQL}, '{s * 2}')" for s in _SIGNS)})"""
)
def noise_titles_strict(spark, sf_dir):
    return filters.noise_titles(_titles(spark, sf_dir), "title", "strict", _SIGNS)


@query("SELECT conv_id, turn FROM conversations WHERE length(text) >= 100")
def min_length(spark, sf_dir):
    rows = filters.min_length(table(spark, sf_dir, "conversations"), "text", 100)
    return rows.select("conv_id", "turn")


@query(
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, count(*) AS n_lines FROM l WHERE line <> '' GROUP BY doc_id"""
)
def drop_empty(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("line")
    )
    return filters.drop_empty(lines, "line").groupBy("doc_id").agg(F.count("*").alias("n_lines"))


@query(
    """WITH k AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS keyword FROM documents),
    p AS (SELECT keyword, [w FOR w IN string_split_regex(
        regexp_replace(keyword, '[^\\p{L}\\p{N}_\\s]', '', 'g'), '\\s+') IF w <> ''] AS w FROM k),
    q AS (SELECT CASE WHEN len(w) = 1 THEN concat('"', w[1], '"') ELSE array_to_string(w, ' ') END
        AS query, keyword FROM p)
    SELECT query, md5(keyword) AS keyword_md5 FROM q WHERE length(query) <= 500"""
)
def build_queries(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("keyword"))
    return keywords.build_queries(lines).select("query", F.md5("keyword").alias("keyword_md5"))


@query(
    """SELECT concat('"', k, '" lang:ko -filter:retweets min_retweets:1 -casino -bets ',
        'since:2023-02-01 until:2024-02-01') AS query, k AS keyword
    FROM (SELECT DISTINCT split_part(p_name, ' ', 2) AS k FROM part)"""
)
def build_queries_full(spark, sf_dir):
    words = table(spark, sf_dir, "part").select(
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("keyword")
    )
    return keywords.build_queries(
        words, lang="ko", min_reposts=1, until="2024-02-01", days=365, exclude=["casino", "bets"]
    )


@query(
    """WITH k AS (SELECT p_name, row_number() OVER (ORDER BY md5(concat('42', p_name)), p_name) - 1
        AS i FROM (SELECT DISTINCT p_name FROM part)),
    c AS (SELECT concat(a.p_name, ' ', b.p_name) AS keyword,
        row_number() OVER (ORDER BY a.i, b.i) - 1 AS number FROM k a JOIN k b ON a.i < b.i),
    n AS (SELECT count(*) AS total FROM c),
    d AS (SELECT pick, total, CAST(floor(pick * total / 50) AS BIGINT) AS low,
        CAST(floor((pick + 1) * total / 50) AS BIGINT) AS high,
        CAST(concat('0x', substring(md5(concat('42:', CAST(pick AS VARCHAR))), 1, 7)) AS BIGINT) AS h
        FROM range(50) r(pick), n)
    SELECT pick, keyword FROM d JOIN c ON number =
        CASE WHEN total <= 50 THEN pick ELSE low + h % (high - low) END"""
)
def keyword_combinations(spark, sf_dir):
    return keywords.keyword_combinations(table(spark, sf_dir, "part"), "p_name")


@query(
    """WITH t AS (SELECT concat('src', CAST(item_id % 20 AS VARCHAR)) AS search_query, item_id,
        regexp_extract_all(text, '[가-힣a-zA-Z0-9]{2,}') AS w FROM benchmark),
    e AS (SELECT search_query, item_id * 100000 + i AS pos, w[i] AS keyword
        FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM t)),
    k AS (SELECT search_query, keyword, min(pos) AS pos FROM e WHERE length(keyword) >= 9
        GROUP BY 1, 2),
    g AS (SELECT search_query, list(keyword ORDER BY pos) AS ks FROM k GROUP BY 1)
    SELECT doc_id AS seq, source AS search_query, coalesce(
        [x FOR x IN ks IF contains(lower(text), lower(x))][1], ks[1]) AS search_keyword
    FROM documents JOIN g ON source = search_query"""
)
def detect_keyword(spark, sf_dir):
    words = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("search_query"),
        "item_id",
        F.posexplode(tx.tokens(F.col("text"))).alias("i", "keyword"),
    )
    pairs = (
        words.filter(F.length("keyword") >= 9)
        .groupBy("search_query", "keyword")
        .agg(F.min(F.col("item_id") * 100000 + F.col("i")).alias("pos"))
    )
    found = keywords.detect_keyword(posts(spark, sf_dir), pairs)
    return found.select("seq", "search_query", "search_keyword")


_LONG_WORDS = """SELECT w AS keyword, min(item_id * 100000 + i) AS pos FROM (
        SELECT item_id, unnest(w) AS w, generate_subscripts(w, 1) AS i
        FROM (SELECT item_id, regexp_extract_all(text, '[가-힣a-zA-Z0-9]{2,}') AS w FROM benchmark))
    WHERE length(w) >= 4 GROUP BY 1 ORDER BY 2, 1 LIMIT """


def _long_words(spark, sf_dir, n):
    """The first ``n`` different words of the benchmark, as a user's long list."""
    words = table(spark, sf_dir, "benchmark").select(
        "item_id", F.posexplode(tx.tokens(F.col("text"))).alias("i", "keyword")
    )
    pos = F.min(F.col("item_id") * 100000 + F.col("i") + 1).alias("pos")
    return words.filter(F.length("keyword") >= 4).groupBy("keyword").agg(pos).orderBy("pos", "keyword").limit(n)


@query(
    f"""WITH k AS ({_LONG_WORDS} 600), g AS (SELECT list(keyword ORDER BY pos, keyword) AS ks FROM k)
    SELECT doc_id AS seq, source AS search_query, coalesce(
        [x FOR x IN ks IF contains(lower(text), lower(x))][1], ks[1]) AS search_keyword
    FROM documents, g WHERE source IN ('src1', 'src2', 'src3')"""
)
def detect_keyword_long(spark, sf_dir):
    """Three search queries, each with a list of 600 keywords."""
    queries = F.explode(F.array(F.lit("src1"), F.lit("src2"), F.lit("src3"))).alias("search_query")
    pairs = _long_words(spark, sf_dir, 600).select(queries, "pos", "keyword")
    found = keywords.detect_keyword(posts(spark, sf_dir), pairs)
    return found.select("seq", "search_query", "search_keyword")


@query(
    f"""WITH k AS ({_LONG_WORDS} 300), g AS (SELECT list(lower(keyword)) AS ks FROM k)
    SELECT doc_id FROM documents, g WHERE len([x FOR x IN ks IF contains(lower(text), x)]) = 0"""
)
def drop_excluded_long(spark, sf_dir):
    """A list of 300 excluded words."""
    words = [r["keyword"] for r in _long_words(spark, sf_dir, 300).collect()]
    return filters.drop_excluded(table(spark, sf_dir, "documents", spread=True), "text", words).select("doc_id")


@query(
    """SELECT doc_id, concat(source, 'x') AS handle,
      split_part(concat(text, ' - ', source), ' - ', 1) AS headline,
      concat('[', source, '] ', text) AS tagged,
      substring(text, 1, 80) AS preview_80, lower(text) AS lowered,
      trim(regexp_replace(text, '[^\\p{L}\\p{N}_\\s]', '', 'g'), chr(9) || chr(10) || chr(12) || chr(13) || ' ')
        AS cleaned FROM documents"""
)
def text_fields(spark, sf_dir):
    text, source = F.col("text"), F.col("source")
    titled = F.concat(text, F.lit(" - "), source)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.clean_handle(F.concat(F.lit(" @"), source, F.lit("x\t"))).alias("handle"),
        tx.strip_publisher(titled).alias("headline"),
        tx.tag_source(source, text).alias("tagged"),
        tx.preview(text).alias("preview_80"),
        F.lower(text).alias("lowered"),
        tx.clean_keyword(text).alias("cleaned"),
    )


@query(
    """SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'unknown'
      ELSE concat('@', string_split(url, '/')[-1]) END AS handle FROM pages"""
)
def page_handles(spark, sf_dir):
    url = F.when(F.col("page_id") % 10 != 0, F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", tx.handle_from_url(url).alias("handle"))


_WHEN_SQL = """CASE event_id % 4 WHEN 0 THEN 'yesterday' WHEN 1 THEN NULL
    WHEN 2 THEN replace(substring(CAST(ts AS VARCHAR), 1, 19), ' ', 'T')
    ELSE substring(CAST(ts AS VARCHAR), 1, 19) END"""


def _times(spark, sf_dir):
    shown = F.substring(F.col("ts").cast("string"), 1, 19)
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, "yesterday")
        .when(kind == 2, F.replace(shown, F.lit(" "), F.lit("T")))
        .when(kind == 3, shown)
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("created_at"))


@query(
    f"""SELECT event_id, strftime(TRY_CAST({_WHEN_SQL} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS at
    FROM events"""
)
def parse_created_at(spark, sf_dir):
    at = F.date_format(tx.parse_created_at(F.col("created_at")), "yyyy-MM-dd HH:mm:ss")
    return _times(spark, sf_dir).select("event_id", at.alias("at"))


@query(
    f"""WITH t AS (SELECT TRY_CAST({_WHEN_SQL} AS TIMESTAMP) AS t FROM events)
    SELECT strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first_at,
           strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last_at FROM t"""
)
def date_range(spark, sf_dir):
    ends = reports.date_range(_times(spark, sf_dir))
    return ends.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ends.columns])


@query(
    f"""WITH c AS (SELECT count(*) AS c0,
        count(*) FILTER (WHERE NOT ({EXCLUDED_SQL})) AS c1,
        count(*) FILTER (WHERE NOT ({EXCLUDED_SQL}) AND length(text) >= 200) AS c2,
        count(*) FILTER (WHERE NOT ({EXCLUDED_SQL}) AND length(text) >= 200 AND lang = 'en') AS c3
        FROM documents)
    SELECT 1 AS step_no, 'words' AS step, c0 AS "before", c0 - c1 AS removed, c1 AS "after",
        round(c1 * 100.0 / c0, 4) + 0.0 AS pct_kept FROM c
    UNION ALL SELECT 2, 'length', c1, c1 - c2, c2, round(c2 * 100.0 / c0, 4) FROM c
    UNION ALL SELECT 3, 'language', c2, c2 - c3, c3, round(c3 * 100.0 / c0, 4) FROM c"""
)
def step_counts(spark, sf_dir):
    steps = {
        "words": ~filters.has_excluded(F.col("text"), EXCLUDED),
        "length": F.length("text") >= 200,
        "language": F.col("lang") == "en",
    }
    out = reports.step_counts(table(spark, sf_dir, "documents", spread=True), steps)
    return out.withColumn("pct_kept", F.round("pct_kept", 4))


@query(
    """SELECT count(DISTINCT source) AS unique_source, count(DISTINCT text) AS unique_text,
      count(DISTINCT lang) AS unique_lang FROM documents"""
)
def unique_counts(spark, sf_dir):
    return reports.unique_counts(table(spark, sf_dir, "documents"), ["source", "text", "lang"])


@query("SELECT count(CASE WHEN length(text) > 100 THEN text END) AS present FROM conversations")
def non_null_count(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        F.when(F.length("text") > 100, F.col("text")).alias("comment_text")
    )
    return reports.non_null_count(rows, "comment_text")


@query(
    """SELECT count(*) AS "rows", count(DISTINCT conv_id) AS videos,
      round(count(*) / count(DISTINCT conv_id), 4) + 0.0 AS rows_per_video FROM conversations"""
)
def comments_per_video(spark, sf_dir):
    out = reports.comments_per_video(table(spark, sf_dir, "conversations"), "conv_id")
    return out.withColumn("rows_per_video", F.round("rows_per_video", 4))


@query("SELECT doc_id, md5(text) AS text_md5 FROM documents ORDER BY doc_id LIMIT 100")
def head_docs(spark, sf_dir):
    first = reports.head_docs(table(spark, sf_dir, "documents"), "doc_id", 100)
    return first.select("doc_id", F.md5("text").alias("text_md5"))


@query(
    """SELECT doc_id, source FROM documents
    ORDER BY md5(concat('42:', CAST(doc_id AS VARCHAR))), doc_id LIMIT 100"""
)
def sample_docs(spark, sf_dir):
    return reports.sample_rows(table(spark, sf_dir, "documents"), "doc_id", 100).select("doc_id", "source")


@query(
    """SELECT text, CAST(0 AS BIGINT) AS reply, CAST(0 AS BIGINT) AS retweet,
      n_chars AS "like", CAST(0 AS BIGINT) AS view, '' AS author_id, '' AS created_at,
      '' AS search_keyword, source AS search_query FROM documents"""
)
def conform(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "text",
        F.col("n_chars").alias("like"),
        F.col("source").alias("search_query"),
        "lang",
    )
    return schemas.conform(rows, schemas.POSTS)
