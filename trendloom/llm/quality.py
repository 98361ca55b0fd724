"""Quality rules: text statistics, and a decision list learned from labelled statistics.

Sequential covering: a rule against bad texts grows one threshold at a time by FOIL gain on two
thirds of the labelled rows, is pruned from its end on the other third, and joins the list if it
is right there often enough; the rows it covers are set aside and the next rule grows. The list
becomes one ordered Spark conditional, so judging a text is a JVM expression.

The list is learned from at most ``max_labelled`` labelled rows (the first by hash of the id);
statistics and verdicts cover all rows and whole texts.

Edge cases: null text is empty and fails for having no words; null labels are left out, of
several labels of one id the least counts; without labels of both kinds the list is empty and
keeps what the base rule keeps; repeated rows are judged alike; other columns are untouched.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.base import SPACE, free, let, query, store, table

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "shouts", "digits")


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more."""

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0), lambda a, b: a + b)

    def twice(pairs: Column) -> Column:
        same = lambda p, j: F.coalesce(F.get(pairs, j)["h"] == p["h"], F.lit(False))
        dup = F.filter(pairs, lambda p, i: same(p, i - 1) | same(p, i + 1))
        return let(F.array_sort(F.transform(dup, lambda p: p["i"])), covered)

    def of_hashes(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, let(pairs, twice)).otherwise(0)

    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) > WINDOW, let(hashes, of_hashes)).otherwise(0)


def with_stats(docs: DataFrame, text: str = "text", name: str = "stats") -> DataFrame:
    """Add a struct with the counts of each text."""

    def stats(t: Column) -> Column:
        trimmed = F.trim(t, F.lit(" \t\n\x0b\f\r"))
        rare = F.regexp_replace(t, f"[a-z{SPACE}]+", "")  # holds all that is counted below, and is short
        words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
        word_counts = let(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
                _repeat_words(w).cast("long").alias("n_repeat_words"),
            ),
        )
        marks = let(
            rare,
            lambda r: F.struct(
                _count(r, f"[{SYMBOLS}]").cast("long").alias("n_symbols"),
                _count(r, "[A-Z]").cast("long").alias("n_capitals"),
                _count(r, "[!?]").cast("long").alias("n_shouts"),
                _count(r, "[0-9]").cast("long").alias("n_digits"),
            ),
        )
        line_counts = let(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        )
        return F.struct(word_counts.alias("words"), marks.alias("marks"), line_counts.alias("lines"))

    parts = docs.withColumn(name, let(F.coalesce(F.col(text), F.lit("")), stats))
    return parts.withColumn(
        name, F.struct(f"{name}.words.*", f"{name}.marks.*", f"{name}.lines.*")
    )


def base_failed(stats: Column) -> Column:
    few = stats["n_words"] < MIN_WORDS
    return few | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


def features(stats: Column) -> list[Column]:
    """What the rules test: the number of words, and shares that do not grow with the text."""
    share = lambda a, b: F.coalesce(stats[a] / F.nullif(stats[b], F.lit(0)), F.lit(0.0))
    columns = (
        stats["n_words"].cast("double"),
        share("word_chars", "n_words"),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        share("n_capitals", "word_chars"),
        share("n_shouts", "n_words"),
        share("n_digits", "word_chars"),
    )
    return [c.alias(name) for name, c in zip(FEATURES, columns, strict=True)]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"

    def holds(self, stats: Column) -> Column:
        value = features(stats)[FEATURES.index(self.feature)]
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class BadRule:
    """A conjunction that marks bad texts, with its right and wrong cases among the pruning rows."""

    conditions: tuple[Condition, ...]
    right: int
    wrong: int

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions)) + f"  ({self.right} right, {self.wrong} wrong)"


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 20_000,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """(features, bad, prune): statistics of labelled texts that the base rule lets pass."""
    sample = (
        labels.filter(F.col(label).isNotNull())
        .groupBy(key)
        .agg(F.min(label).alias("_label"))
        .orderBy(F.xxhash64(key), key)
        .limit(max_labelled)
    )
    # Written, or Spark would test base_failed below the join and so count all documents.
    known = store(docs.select(key, text).join(F.broadcast(sample), key), "labelled")
    judged = with_stats(known, text, "_stats").filter(~base_failed(F.col("_stats")))
    return judged.select(
        *features(F.col("_stats")),
        (F.col("_label") == 0).alias("bad"),
        (F.pmod(F.xxhash64(F.lit("prune"), key), F.lit(3)) == 0).alias("prune"),
    )


def learn(
    rows: list,
    least_right: int = 5,
    least_precision: float = 0.95,
    max_rules: int = 12,
    max_conditions: int = 4,
    cuts: int = 64,
) -> list[BadRule]:
    """The ordered rules. ``rows``: collected rows of ``labelled``, a bounded number of them.

    Sets of rows are the bits of an integer, so trying a condition is one ``&`` and a count.
    """
    rows = sorted(rows, key=lambda r: tuple(r[f] for f in FEATURES) + (r["bad"], r["prune"]))
    bits = lambda chosen: sum(1 << i for i, r in enumerate(rows) if chosen(r))
    bad, prune = bits(lambda r: r["bad"]), bits(lambda r: r["prune"])
    masks: dict[Condition, int] = {}
    everything = (1 << len(rows)) - 1
    for name in FEATURES:
        values = sorted({r[name] for r in rows})
        by_value = sorted(range(len(rows)), key=lambda i: rows[i][name])
        step = max(1, len(values) // cuts)
        gaps = list(zip(values, values[1:], strict=False))
        chosen = set(range(0, len(gaps), step))
        step = max(1, len(rows) // cuts)
        chosen |= {bisect_left(values, rows[by_value[i]][name]) for i in range(0, len(rows), step)}
        marks = [(gaps[i][0] + gaps[i][1]) / 2 for i in sorted(chosen) if i < len(gaps)]
        mask, at = 0, 0
        for mark in marks:
            while at < len(by_value) and rows[by_value[at]][name] <= mark:
                mask |= 1 << by_value[at]
                at += 1
            masks[Condition(name, False, mark)] = mask
            masks[Condition(name, True, mark)] = everything & ~mask
    left, out = everything, []
    while len(out) < max_rules:
        covered, conditions = left & ~prune, []
        while len(conditions) < max_conditions and covered & ~bad:
            p, n = (covered & bad).bit_count(), (covered & ~bad).bit_count()
            if not p:
                break
            best, gain = None, 1e-9
            for condition, mask in masks.items():
                q = (covered & mask & bad).bit_count()
                if q:
                    m = (covered & mask & ~bad).bit_count()
                    won = q * (log2(q / (q + m)) - log2(p / (p + n)))
                    if won > gain:
                        best, gain = condition, won
            if best is None:
                break
            conditions.append(best)
            covered &= masks[best]
        choices = []
        for k in range(1, len(conditions) + 1):
            held = left & prune
            for condition in conditions[:k]:
                held &= masks[condition]
            right, wrong = (held & bad).bit_count(), (held & ~bad).bit_count()
            choices.append(((right + 1) / (right + wrong + 2), -k, right, wrong))
        if not choices:
            break
        worth, k, right, wrong = max(choices)
        if right < least_right or right < least_precision * (right + wrong):
            break
        rule = BadRule(tuple(conditions[:-k]), right, wrong)
        out.append(rule)
        held = left
        for condition in rule.conditions:
            held &= masks[condition]
        left &= ~held
    return out


def verdict(stats: Column, rules: list[BadRule]) -> Column:
    """True for texts to keep: the first rule that holds rejects, the default keeps."""
    out = F.lit(True)
    for rule in reversed(rules):
        holds = F.lit(True)
        for condition in rule.conditions:
            holds = holds & condition.holds(stats)
        out = F.when(holds, F.lit(False)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """``docs`` with ``stats``, ``base_failed`` and ``kept``, which replace columns of these names; the
    rules are learned on the way."""
    rules = learn(labelled(docs, labels, max_labelled).collect())  # max_labelled rows at most
    judged = with_stats(docs).withColumn("base_failed", base_failed(F.col("stats")))
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(F.col("stats"), rules))


def passing(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """The rows of ``docs`` to keep, with the columns of ``docs`` and whatever their names."""
    rules = learn(labelled(docs, labels, max_labelled).collect())
    name = free("_stats", docs.columns)
    stats = F.col(name)
    judged = with_stats(docs, name=name)
    return judged.filter(~base_failed(stats) & verdict(stats, rules)).drop(name)


@query("op8_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their counts and the verdict of rules learned from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judge(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", *[F.col("stats")[c].alias(c) for c in counts], "base_failed", "kept"
    )
