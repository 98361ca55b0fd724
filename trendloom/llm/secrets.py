"""Secret scan with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger has a row per
(blob, rule, version) that was ever scanned, with the spans found, none included. A run scans
only pairs the ledger lacks, once per blob however many paths hold it, and joins the findings
back to all paths. Raising the version of a rule scans it again, and it alone.

Base rules find assignments, access keys and long hex runs; the further rules know token forms
that carry their own prefix. A private key runs from its BEGIN line through the matching END line;
where that is missing, through its headers and the last of the base64 lines that follow, line
breaks being real or escaped. Spans are in code points, end exclusive.

Edge cases: null text is empty and has no findings but a row in the ledger; repeated rows are
paths of one blob; an empty table gives an empty ledger; other columns stay out of the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.base import free, query, store, table


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` code points; ``hint`` is a cheaper test that no match fails."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    hint: str | None = None
    version: int = 1


ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE = (
    Rule("assign", ASSIGN, 12, 2, r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"),
    Rule("access", r"AKIA[A-Z0-9]+", 18, hint=r"AKIA[A-Z0-9]{14}"),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
# Loops are possessive: Java walks those without recursion, and bodies have any length.
KEY_NAME = r"((?:(?!PRIVATE\x20KEY-)[A-Z]++\x20)*+)PRIVATE\x20KEY-----"
KEY_BREAK = r"(?:[\x20\t\"',;+]*+(?:\\r)?+(?:\r\n?+|\n|\\n)[\x20\t>#*\"'+]*+)++"
KEY_LINE = r"[A-Za-z0-9+/]++={0,2}+(?=[\x20\t\"',;+]*+(?:[\r\n\\]|\z))"
KEY_LONG = r"[A-Za-z0-9+/]{40,}+={0,2}+"
KEY_HEADER = r"[A-Z][A-Za-z0-9]*+-[A-Za-z0-9-]++:[^\r\n\\]*+"
KEY_CUT = rf"(?:{KEY_BREAK}{KEY_HEADER})*+(?:{KEY_BREAK}(?:{KEY_LONG}|{KEY_LINE})|[\x20\t]*+{KEY_LONG}(?:[\x20\t]++{KEY_LINE})?+)*+"
PRIVATE_KEY = rf"-----BEGIN\x20{KEY_NAME}(?:(?:[^-]++|-(?!----))*+-----END\x20\1PRIVATE\x20KEY-----|{KEY_CUT})"
SPANS = "array<struct<kind:string,start:int,end:int>>"
MORE = (
    Rule("private_key", PRIVATE_KEY, hint="-----BEGIN ", version=2),
    Rule("git_token", r"\bgh[opsur]_[A-Za-z0-9]{36,255}", hint="gh[opsur]_"),
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint=r"\.eyJ"),
)
RULES = BASE + MORE


def spans(text: Column, rule: Rule) -> Column:
    """array<struct<kind, start, end>> of the rule's matches, leftmost and not overlapping.

    The texts between the matches and the matches themselves alternate, so their lengths give
    every position; texts without the hint are not taken apart at all.
    """
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    step = F.arrays_zip(
        F.slice(between, 1, F.size(found)).alias("gap"),
        F.transform(found, F.length).alias("n"),
        F.transform(judged, F.length).alias("judged"),
    )
    empty = F.array().cast(SPANS)
    zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def add(state: Column, s: Column) -> Column:
        start = state["at"] + s["gap"]
        end = start + s["n"]
        span = F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end"))
        out = F.when(s["judged"] >= rule.least, F.array_append(state["out"], span)).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    walked = F.aggregate(step, zero, add, lambda s: s["out"])
    return F.when(text.rlike(rule.hint or rule.pattern), walked).otherwise(empty)


def blobs(paths: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob): the content address of each version."""
    return paths.select(path, F.sha2(F.coalesce(text, F.lit("")), 256).alias("blob"))


def scan(
    paths: DataFrame,
    ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
    path: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The ledger rows (blob, rule, version, spans) that ``ledger`` lacks for these paths.

    One path stands for each blob, and only texts with a missing pair reach the expressions.
    A path may have many versions: path and blob together name one.
    """
    rows = paths.select(F.col(path).alias("path"), F.coalesce(text, F.lit("")).alias("text")).withColumn(
        "blob", F.sha2("text", 256)
    )
    rules = list(rules)
    known = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    todo = rows.groupBy("blob").agg(F.min("path").alias("path")).withColumn("todo", known)
    if ledger is not None:
        done = ledger.groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("done"))
        left = F.array_except("todo", F.coalesce("done", F.array().cast("array<struct<rule:string,version:int>>")))
        todo = todo.join(done, "blob", "left").withColumn("todo", left).drop("done").filter(F.size("todo") > 0)
    chosen = todo.withColumnRenamed("path", "one").withColumnRenamed("blob", "address")
    texts = rows.join(chosen, (F.col("blob") == F.col("address")) & F.col("path").eqNullSafe(F.col("one")))
    each = [
        F.when(
            F.array_contains(F.transform("todo", lambda t: t["rule"]), r.kind),
            F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), spans(F.col("text"), r).alias("spans")),
        )
        for r in rules
    ]
    found = texts.select("blob", F.filter(F.array(*each), lambda x: x.isNotNull()).alias("found"))
    return found.dropDuplicates(["blob"]).select("blob", F.inline("found"))


def _by_blob(ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, spans) of blobs with findings: spans of the rules' present versions, by start."""
    versions = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    ranked = F.transform("all", lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"]))
    return (
        ledger.filter(F.array_contains(versions, F.struct("rule", "version")) & (F.size("spans") > 0))
        .dropDuplicates(["blob", "rule", "version"])
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("spans")).alias("all"))
        .select("blob", F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("spans"))
    )


def findings(
    paths: DataFrame,
    ledger: DataFrame,
    rules: Sequence[Rule] = RULES,
    path: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(path, blob, spans): the findings of every path."""
    of_blob = _by_blob(ledger, rules)
    return blobs(paths, path, text).join(of_blob, "blob", "left").select(
        path, "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans")
    )


def redact(
    docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", mask: str = "[secret]"
) -> DataFrame:
    """``docs`` with ``mask`` in place of every finding; findings that overlap are masked as one."""
    names = docs.columns
    blob, own = free("_blob", names), free("_spans", names)
    hashed = docs.withColumn(blob, F.sha2(F.coalesce(text, F.lit("")), 256))
    found = _by_blob(ledger, rules).select(F.col("blob").alias(blob), F.col("spans").alias(own))
    value = F.col(text)

    def add(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.concat(F.substr(value, state["at"] + 1, s["start"] - state["at"]), F.lit(mask))
        out = F.concat(state["out"], F.when(fresh, gap).otherwise(""))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], F.substr(value, s["at"] + 1, F.length(value)))
    masked = F.when(F.col(own).isNull(), value).otherwise(F.aggregate(own, zero, add, rest))
    return hashed.join(found, blob, "left").withColumn(text, masked).select(*names)


def joined(spans_: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op5_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: digest of the base spans and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = store(scan(docs), "ledger")
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in BASE]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return findings(docs, ledger).select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
