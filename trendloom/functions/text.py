"""Text columns: handles, keywords, headlines, tokens and n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what counts as a token without a tagger.
TOKEN_PATTERN = "[가-힣a-zA-Z0-9]{2,}"
# Java's \w knows ASCII only and would delete Hangul, so the classes are spelled out.
_NOT_WORD = r"[^\p{L}\p{N}_\s]"
_EDGE_SPACE = r"^\s+|\s+$"


def squash(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def clean_handle(author: Column) -> Column:
    return squash(F.replace(author.cast("string"), F.lit("@"), F.lit("")))


def handle_from_url(url: Column, unknown: str = "unknown") -> Column:
    last = F.element_at(F.split(url, "/"), -1)
    return F.when(F.coalesce(url, F.lit("")) != "", F.concat(F.lit("@"), last)).otherwise(unknown)


def clean_keyword(keyword: Column) -> Column:
    return squash(F.regexp_replace(keyword, _NOT_WORD, ""))


def strip_publisher(title: Column) -> Column:
    return F.split_part(title, F.lit(" - "), F.lit(1))


def tag_source(source: Column, title: Column) -> Column:
    return F.concat(F.lit("["), source, F.lit("] "), title)


def parse_created_at(text: Column) -> Column:
    """ISO text to timestamp; unreadable text becomes null instead of failing the job."""
    return F.try_to_timestamp(text.cast("string"))


def preview(text: Column, n: int = 80) -> Column:
    return F.substring(text, 1, n)


def tokens(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def words(text: Column) -> Column:
    """Split on white space; no empty words."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def drop_stopwords(tokens_col: Column, stop: Sequence[str] = (), min_length: int = 2) -> Column:
    """Keeps repeats and order, unlike array_except."""

    def keep(token: Column) -> Column:
        long_enough = F.length(token) >= min_length
        return long_enough & ~token.isin(list(stop)) if stop else long_enough

    return F.filter(tokens_col, keep)


def keep_tags(tagged: Column, tags: Iterable[str] = (), prefixes: Iterable[str] = ()) -> Column:
    """Forms of an array<struct<form,tag>> whose tag is listed or starts with a prefix."""
    tags, prefixes = list(tags), list(prefixes)

    def wanted(item: Column) -> Column:
        hit = item["tag"].isin(tags) if tags else F.lit(False)
        for prefix in prefixes:
            hit = hit | item["tag"].startswith(prefix)
        return hit

    return F.transform(F.filter(tagged, wanted), lambda item: item["form"])


def ngrams(tokens_col: Column, low: int = 1, high: int = 2) -> Column:
    """All runs of low..high neighbouring tokens, joined by one space."""

    def runs(n: int) -> Column:
        # Shifted copies are zipped: a lambda that looked into the whole array by position
        # would have the array computed again for every position.
        count = F.greatest(F.size(tokens_col) - (n - 1), F.lit(0))
        joined = F.slice(tokens_col, F.lit(1), count)
        for shift in range(1, n):
            shifted = F.slice(tokens_col, F.lit(shift + 1), count)
            joined = F.zip_with(joined, shifted, lambda a, b: F.concat_ws(" ", a, b))
        return joined

    return F.concat(*[runs(n) for n in range(low, high + 1)])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_once(
    df: DataFrame, name: str, value: Column, keep: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add a column that is computed once per row, and drop rows where ``keep`` of it is false.

    A plain column is pasted into every filter and projection that uses it; an expensive one
    would then run once for each of them.
    """
    box = F.array(value)
    if keep is not None:
        box = F.filter(box, keep)
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*others, F.explode(box).alias(name))


def contains_any(text: Column, strings: Sequence[str]) -> Column:
    """True where the text holds at least one of a few fixed strings; null text stays null.

    One test per string, compiled into the scan. Word lists go to ``matcher.holds_any``.
    """
    usable = sorted({s for s in strings if s})
    if not usable:
        return F.when(text.isNotNull(), F.lit(False))
    return _any([F.contains(text, F.lit(s)) for s in usable])


def _any(tests: list[Column]) -> Column:
    """The tests joined by OR, halved and halved again so that the expression stays flat."""
    if len(tests) == 1:
        return tests[0]
    middle = len(tests) // 2
    return _any(tests[:middle]) | _any(tests[middle:])


def digest(value: Column) -> Column:
    """Stands for a text where only equality counts: long text shrinks to its SHA-256."""
    return F.when(F.length(value) > 40, F.sha2(value, 256)).otherwise(value)


def percent(part: Column, whole: Column) -> Column:
    """Null on an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole)
