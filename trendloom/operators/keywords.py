"""Keywords: search queries, combinations, detection in text, and per-query limits."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import session
from trendloom.functions import matcher
from trendloom.functions import text as tx
from trendloom.functions.lookup import OpenTable
from trendloom.operators import dedup, filters, skew


def build_queries(
    keywords: DataFrame,
    column: str = "keyword",
    max_length: int = 500,
    lang: str | None = None,
    min_reposts: int | None = None,
    until: str | None = None,
    days: int = 365,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """(query, keyword): one search query per distinct keyword.

    One word is quoted, more words are joined by blanks. The further parts are off unless
    asked for; ``until`` is an ISO date, so that a rerun builds the same queries.
    """
    distinct = keywords.select(F.col(column).alias("keyword")).dropna().distinct()
    parts = tx.words(tx.clean_keyword(F.col("keyword")))
    core = F.when(
        F.size(parts) == 1, F.concat(F.lit('"'), F.element_at(parts, 1), F.lit('"'))
    ).otherwise(F.array_join(parts, " "))
    pieces: list[Column] = [core]
    if lang:
        pieces.append(F.lit(f"lang:{lang}"))
    if min_reposts:
        pieces += [F.lit("-filter:retweets"), F.lit(f"min_retweets:{min_reposts}")]
    if exclude:
        pieces.append(F.lit(" ".join(f"-{w}" for w in exclude)))
    if until:
        end = F.to_date(F.lit(until))
        pieces.append(F.concat(F.lit("since:"), F.date_format(F.date_sub(end, days), "yyyy-MM-dd")))
        pieces.append(F.concat(F.lit("until:"), F.date_format(end, "yyyy-MM-dd")))
    return distinct.select(F.concat_ws(" ", *pieces).alias("query"), "keyword").filter(
        F.length("query") <= max_length
    )


def keyword_combinations(
    keywords: DataFrame, column: str = "keyword", size: int = 2, limit: int = 50, seed: str = "42"
) -> DataFrame:
    """(pick, keyword): at most ``limit`` different sets of ``size`` keywords.

    The sets are numbered 0 .. C(n, size) - 1 over the keywords in hash order. The numbers
    are cut into ``limit`` equal stretches and one is drawn from each by hash, so only the
    chosen sets are ever built. With fewer sets than ``limit`` all of them come out.
    """
    numbered = skew.dense_index(dedup.distinct_values(keywords, column), column, seed)
    n = numbered.agg(F.count("*")).scalar()
    spark = keywords.sparkSession
    picks = spark.range(limit).select(F.col("id").alias("pick"), n.alias("n"))

    def members(batches):
        for batch in batches:
            rows = []
            for pick, count in zip(batch["pick"], batch["n"]):
                total = math.comb(int(count), size)
                number = _draw(int(pick), total, limit, seed)
                if number is not None:
                    ids = _unrank(number, int(count), size)
                    rows += [(int(pick), place, i) for place, i in enumerate(ids)]
            yield pd.DataFrame(rows, columns=["pick", "place", "idx"])

    chosen = picks.mapInPandas(members, "pick bigint, place int, idx bigint")
    # At most limit * size rows: both are parameters, so this side never grows with the data.
    named = numbered.join(F.broadcast(chosen), "idx")
    ordered = F.array_sort(F.collect_list(F.struct("place", column)))
    return named.groupBy("pick").agg(
        F.array_join(F.transform(ordered, lambda s: s[column]), " ").alias("keyword")
    )


def _draw(pick: int, total: int, limit: int, seed: str) -> int | None:
    """The set number drawn from stretch ``pick`` of ``limit``, or None past the end."""
    import hashlib

    if total <= limit:
        return pick if pick < total else None
    low, high = pick * total // limit, (pick + 1) * total // limit
    digest = hashlib.md5(f"{seed}:{pick}".encode()).hexdigest()
    return low + int(digest[:7], 16) % (high - low)


def _unrank(number: int, n: int, size: int) -> list[int]:
    """Members of the set with this number in lexicographic order."""
    out, start = [], 0
    for left in range(size, 0, -1):
        before = math.comb(n - start, left)
        low, high = start, n - left
        while low < high:  # the last first-member i whose sets begin at or before ``number``
            mid = (low + high + 1) // 2
            if before - math.comb(n - mid, left) <= number:
                low = mid
            else:
                high = mid - 1
        number -= before - math.comb(n - low, left)
        out.append(low)
        start = low + 1
    return out


BLOCK_BYTES = 8 << 20


def _blocks(pairs: DataFrame, size: int) -> Iterator[list[tuple[str, int, str, str]]]:
    """(search_query, pos, keyword, lowered) in blocks of at most ``size`` bytes of text, one at a time."""
    named = pairs.select("search_query", F.col("pos").cast("bigint").alias("pos"), "keyword", F.lower("keyword").alias("lowered"))
    block: list[tuple[str, int, str, str]] = []
    used = 0
    for row in named.dropna().distinct().toLocalIterator():
        cost = len(row["search_query"]) + 2 * len(row["keyword"]) + 32
        if block and used + cost > size:
            yield block
            block, used = [], 0
        block.append(tuple(row))
        used += cost
    if block:
        yield block


def _detector(block: list[tuple[str, int, str, str]]) -> Callable[[Column, Column], Column]:
    """(query, lowered text) to struct<missing, pos, keyword>: the first keyword of the block's list for
    that query which the text holds, else the first of the list; null for a query that has none here."""
    block = sorted(block)
    queries = sorted({b[0] for b in block})
    lowered = sorted({b[3] for b in block})
    number, place = {q: i for i, q in enumerate(queries)}, {w: i for i, w in enumerate(lowered)}
    words = matcher.Matcher(lowered)
    # The keyword of least rank stands for a word that a query lists twice.
    rank_of: dict[int, int] = {}
    head = np.full(len(queries), -1, np.int64)
    for rank, (query, _, _, word) in enumerate(block):
        rank_of.setdefault(number[query] * len(lowered) + place[word], rank)
        if head[number[query]] < 0:
            head[number[query]] = rank
    pairs = OpenTable(len(rank_of))
    pairs.add(np.array(list(rank_of), np.int64), np.array(list(rank_of.values()), np.int32))
    pos, names = np.array([b[1] for b in block], np.int64), pa.array([b[2] for b in block])
    known = pa.array(queries)

    @F.arrow_udf("struct<missing: int, pos: bigint, keyword: string>")
    def detect(query: pa.Array, text: pa.Array) -> pa.Array:
        own = pc.fill_null(pc.index_in(query, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        rows, strings = words.matches(text)
        of_query = np.where(own[rows] >= 0, own[rows] * len(lowered) + strings, -1)
        ranks = pairs.find(of_query).astype(np.int64)
        never = len(block)
        best = np.full(len(query), never)
        np.minimum.at(best, rows[ranks >= 0], ranks[ranks >= 0])
        missing = best == never
        chosen = np.where(missing, head[own], best)
        chosen[own < 0] = 0
        picked = pa.array(chosen)
        parts = [pa.array(missing.astype(np.int32)), pa.array(pos[chosen]), names.take(picked)]
        return pa.StructArray.from_arrays(parts, ["missing", "pos", "keyword"], mask=pa.array(own < 0))

    return detect


def detect_keyword(
    posts: DataFrame, pairs: DataFrame, column: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``posts`` with ``search_keyword``: the first keyword of the row's query found in the text, else
    the first of the query's list. Rows whose query has no keyword are left out.

    ``pairs`` is (search_query, pos, keyword); ``pos`` orders a list. All keywords are looked for in one
    pass over a text. Lists above ``block_bytes`` are handed out in blocks, whose findings are put
    together; between blocks the rows are written. Posts are neither shuffled nor repeated.
    """
    best = next(n for n in (f"_best{'_' * i}" for i in range(99)) if n not in posts.columns)
    found = posts.withColumn(best, F.lit(None).cast("struct<missing: int, pos: bigint, keyword: string>"))
    for number, block in enumerate(_blocks(pairs, block_bytes)):
        if number:
            found = session.cut_lineage(found)
        here = _detector(block)(F.col("search_query"), F.lower(F.col(column)))
        found = found.withColumn(best, F.least(F.col(best), here) if number else here)
    return found.filter(F.col(best).isNotNull()).withColumn("search_keyword", F.col(best)["keyword"]).drop(best)


def limit_per_query(
    posts: DataFrame,
    n: int = 200,
    noise_words: Sequence[str] = (),
    prefix: int = 50,
    query: str = "search_query",
    column: str = "text",
    order: str = "seq",
) -> DataFrame:
    """Noise filter, prefix dedup, then the first n posts per query in arrival order."""
    clean = filters.is_clean(posts, column, noise_words)
    unique = dedup.dedup_prefix(clean, column, query, [order], prefix)
    return skew.first_n(unique, [query], [F.col(order)], n, rank="rank")


def scan_report(
    posts: DataFrame,
    noise_words: Sequence[str] = (),
    prefix: int = 50,
    query: str = "search_query",
    column: str = "text",
) -> DataFrame:
    """Per query: rows scanned, kept, dropped as noise, dropped as repeated."""
    clean = filters.clean_text(F.col(column), noise_words) if noise_words else F.lit(True)
    # One row per (query, beginning) leaves the first step, so the second is light.
    per_prefix = (
        posts.select(query, F.substring(column, 1, prefix).alias("_p"), clean.alias("_clean"))
        .groupBy(query, "_p")
        .agg(F.count("*").alias("_n"), F.count_if("_clean").alias("_c"))
    )
    return per_prefix.groupBy(query).agg(
        F.sum("_n").alias("scanned"),
        F.count_if(F.col("_c") > 0).alias("kept"),
        F.sum(F.col("_n") - F.col("_c")).alias("noise"),
        F.sum(F.when(F.col("_c") > 0, F.col("_c") - 1).otherwise(0)).cast("bigint").alias("repeated"),
    )


def comments_limit(rows: DataFrame, n: int = 100, min_length: int = 15) -> DataFrame:
    """Per video the description, if any, and then comments, n + 1 rows in all.

    Short comments are left out first and repeats of a comment removed, then the limit counts.
    """
    long_enough = rows.filter(
        (F.col("type") == "description") | (F.length("comment") >= min_length)
    )
    is_comment = F.when(F.col("type") == "description", 0).otherwise(1)
    unique = dedup.dedup_first(long_enough, ["video_url", "type", "author", "comment"], ["seq"])
    return skew.first_n(unique, ["video_url"], [is_comment, F.col("seq")], n + 1, rank="rank")


def videos_per_keyword(
    videos: DataFrame, n: int = 10, keyword: str = "search_keyword", order: str = "seq"
) -> DataFrame:
    """The first n regular videos found per keyword."""
    return skew.first_n(filters.watch_links(videos), [keyword], [F.col(order)], n, rank="rank")
