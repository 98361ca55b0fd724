"""Abbreviated counts ("1.2K", "3만", "조회수 70,454회") to whole numbers, in four dialects.

Each dialect is a list of (markers, factor) tried in order. The first marker found in the
text decides: all markers of that rule are taken out, the rest must be a number, and the
product is cut to a whole number. Text without a marker yields its first run of digits.
Whatever cannot be read counts as 0; the status column tells the cases apart.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions import text as tx


@dataclass(frozen=True)
class Dialect:
    drop: tuple[str, ...]
    units: tuple[tuple[tuple[str, ...], int], ...]
    digits: str
    strip: bool = True


# The words, the units and their order decide the result.
_K, _M = (("K",), 1_000), (("M",), 1_000_000)
_VIDEO_DROP = (",", "회", "views", "subscribers", "구독자", "명")
DIALECTS = {
    "post": Dialect((",",), (_K, _M), r"[0-9]+", strip=False),
    "author": Dialect((",",), (_K, _M, (("만",), 10_000)), r"[0-9.]+"),
    "video": Dialect(
        _VIDEO_DROP,
        (
            (("만",), 10_000),
            (("억",), 100_000_000),
            (("K", "천"), 1_000),
            (("M", "백만"), 1_000_000),
        ),
        r"[0-9.]+",
    ),
    "video_fixed": Dialect(
        ("조회수", *_VIDEO_DROP),
        (
            (("M", "백만"), 1_000_000),
            (("만",), 10_000),
            (("억",), 100_000_000),
            (("K", "천"), 1_000),
        ),
        r"[0-9.]+",
    ),
}

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_EDGE_SPACE = r"^[\s 　]+|[\s 　]+$"


def _without(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda acc, w: F.replace(acc, F.lit(w), F.lit("")), words, text)


def _number(text: Column) -> Column:
    """Digits are tested before the cast: a bare cast would also take '1.2d' or 'Infinity'."""
    trimmed = F.regexp_replace(text, _EDGE_SPACE, "")
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def parse_count(text: Column, dialect: str) -> Column:
    """struct<value bigint, status string>; status is empty, unit, digits, none or failed."""
    rules = DIALECTS[dialect]

    def read(body: Column) -> Column:
        run = F.regexp_extract(body, rules.digits, 0)
        value = F.when(run != "", _number(run).try_cast("bigint"))  # null where not readable
        kind = F.when(run != "", "digits").otherwise("none")
        for markers, factor in reversed(rules.units):
            found = reduce(lambda a, b: a | b, [F.contains(body, F.lit(m)) for m in markers])
            scaled = (_number(_without(body, markers)) * F.lit(float(factor))).try_cast("bigint")
            value = F.when(found, scaled).otherwise(value)
            kind = F.when(found, "unit").otherwise(kind)
        return F.struct(value.alias("value"), kind.alias("kind"))

    def settle(read_value: Column) -> Column:
        value, kind = read_value["value"], read_value["kind"]
        status = (
            F.when(F.coalesce(text.cast("string"), F.lit("")) == "", "empty")
            .when(value.isNull() & (kind != "none"), "failed")
            .otherwise(kind)
        )
        known = F.coalesce(value, F.lit(0).cast("bigint"))
        return F.struct(known.alias("value"), status.alias("status"))

    body = _without(F.coalesce(text.cast("string"), F.lit("")), rules.drop)
    if rules.strip:
        body = F.regexp_replace(body, _EDGE_SPACE, "")
    return tx.let(body, lambda b: tx.let(read(b), settle))


def count_value(text: Column, dialect: str) -> Column:
    return parse_count(text, dialect)["value"]


def normalise_counts(
    df: DataFrame, columns: list[str], dialect: str, status_suffix: str | None = "_status"
) -> DataFrame:
    """Replace each raw text column by its number, next to a status column per value."""
    parsed = df
    for name in columns:
        parsed = tx.with_once(parsed, f"_{name}", parse_count(F.col(name), dialect))
    added = {name: F.col(f"_{name}.value") for name in columns}
    if status_suffix:
        added |= {f"{name}{status_suffix}": F.col(f"_{name}.status") for name in columns}
    return parsed.withColumns(added).drop(*[f"_{name}" for name in columns])


def parse_report(df: DataFrame, column: str, dialect: str) -> DataFrame:
    """How many values each rule read, and how many fell back to 0."""
    return (
        df.select(parse_count(F.col(column), dialect)["status"].alias("status"))
        .groupBy("status")
        .agg(F.count("*").alias("n"))
    )
