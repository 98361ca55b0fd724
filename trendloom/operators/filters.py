"""Row filters by word lists, length, links and title noise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions import matcher
from trendloom.functions import text as tx

# The signs that make a headline noise when repeated.
NOISE_SIGNS = ("ㅋ", "ㅎ", "ㄷ", "ㅇㅇ", "...", "??", "!!")
_JAMO = "ㅋㅎㄷㅇ"


def has_excluded(text: Column, words: Sequence[str], strict_reference: bool = False) -> Column:
    """True where the lower-cased text holds a word, and for null text.

    By default words are lower-cased too. ``strict_reference`` leaves them as written, so a
    word with capitals then never matches.
    """
    wanted = list(words) if strict_reference else [w.lower() for w in words]
    return F.coalesce(matcher.holds_any(F.lower(text), [w for w in wanted if w]), F.lit(True))


def drop_excluded(
    df: DataFrame, column: str, words: Sequence[str], strict_reference: bool = False
) -> DataFrame:
    return df.filter(~has_excluded(F.col(column), words, strict_reference))


def clean_text(text: Column, words: Sequence[str], strict_reference: bool = False) -> Column:
    """As has_excluded, negated, but null text is read as the word 'none' and so kept."""
    return ~has_excluded(F.coalesce(text, F.lit("none")), words, strict_reference)


def is_clean(df: DataFrame, column: str, words: Sequence[str] = ()) -> DataFrame:
    return df.filter(clean_text(F.col(column), words)) if words else df


def noise_hits(df: DataFrame, column: str, themes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows hit per theme of the word list, in one pass."""
    lists = [[w.lower() for w in words if w] for words in themes.values()]
    held = df.select(matcher.groups_held(F.lower(F.col(column)), lists).alias("_held"))
    counts = held.agg(*[F.count_if(F.array_contains("_held", i)).alias(theme) for i, theme in enumerate(themes)])
    return counts.unpivot([], list(themes), "theme", "hits")


def min_similarity(df: DataFrame, threshold: float, column: str = "tech_similarity") -> DataFrame:
    return df.filter(F.col(column) >= threshold)


def min_length(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.filter(F.length(column) >= n)


def watch_links(df: DataFrame, column: str = "url", marker: str = "/watch?v=") -> DataFrame:
    return df.filter(F.contains(F.col(column), F.lit(marker)))


def title_is_noise(title: Column, mode: str, signs: Sequence[str] = NOISE_SIGNS) -> Column:
    if mode == "loose":
        return (F.length(title) < 2) | tx.contains_any(title, [s * 3 for s in signs])
    if mode == "strict":
        only_jamo = F.translate(title, " " + _JAMO, "") == ""
        return (F.length(title) < 5) | tx.contains_any(title, [s * 2 for s in signs]) | only_jamo
    raise ValueError(f"unknown mode: {mode}")


def noise_titles(
    df: DataFrame, column: str, mode: str, signs: Sequence[str] = NOISE_SIGNS
) -> DataFrame:
    """Keep the titles that are not noise."""
    return df.filter(~title_is_noise(F.col(column), mode, signs))


def drop_empty(df: DataFrame, *columns: str) -> DataFrame:
    tests = [F.col(c).isNotNull() & (F.col(c) != "") for c in columns]
    return df.filter(reduce(lambda a, b: a & b, tests))


def drop_noise_topic(df: DataFrame, column: str = "topic_id", noise: int = -1) -> DataFrame:
    return df.filter(F.col(column) != noise)
