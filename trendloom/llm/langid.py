"""Language of texts by fusing evidence.

For each language the logarithms add up of: the likelihood of the text (hashed byte trigrams,
tempered since neighbouring trigrams depend on each other), of the declared markup language, of
the address suffix, and the prior of the host. Priors are smoothed down a hierarchy: the host
leans on its site (last two labels of its name), the site on the whole collection. The tables
come from grouped aggregation over all rows, whose languages are first told by text alone; a row
never counts towards its own prior. Evidence that is null says nothing.

The text model learns from at most ``max_labelled`` labelled rows (the first by hash of the id).

Edge cases: null text is empty and leaves the decision to the other evidence; without labelled
rows there is no language to choose from and ``lang`` is null; ties go to the first language by
name; repeated rows count each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.base import query, store, table
from trendloom.llm.byteops import buffers

BITS = 15
FOLD = np.arange(256, dtype=np.uint32)
FOLD[65:91] += 32
FOLD[9:14] = 32
EVIDENCE = ("text", "declared", "suffix", "host")


def _trigrams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bin of the trigram at every byte, and whether it stays inside its text."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    folded = FOLD[data]
    packed = folded[:-2] | (folded[1:-1] << np.uint32(8)) | (folded[2:] << np.uint32(16))
    bins = ((packed * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
    inside = np.ones(len(bins), bool)
    for back in (1, 2):
        at = ends[1:-1] - back
        inside[at[(at >= 0) & (at < len(bins))]] = False
    return bins, inside


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for at in range(batch.num_rows):
            part = batch.slice(at, 1)
            lang = part.column(0)[0].as_py()
            data, ends = buffers(part.column(1))
            bins, _ = _trigrams(data, ends)
            sums[lang] = sums.get(lang, 0) + np.bincount(bins, minlength=1 << BITS)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums)), pa.array([x.astype("<i8").tobytes() for x in sums.values()])], ["lang", "bins"]
        )


def learn(labelled: DataFrame, max_labelled: int = 20_000, tasks: int = 16) -> tuple[list[str], np.ndarray]:
    """The languages and, a row for each, the log probabilities of trigram bins.

    ``labelled``: (doc_id, lang, text). A language has a row of counts from each of ``tasks``.
    """
    rows = labelled.filter(F.col("lang").isNotNull())
    chosen = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).distinct()
    sample = rows.join(F.broadcast(chosen), "doc_id").select("lang", F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    sums: dict[str, np.ndarray] = {}
    for row in sample.coalesce(tasks).mapInArrow(_counts, "lang string, bins binary").collect():
        sums[row.lang] = sums.get(row.lang, 0) + np.frombuffer(row.bins, "<i8")
    langs = sorted(sums)
    if not langs:
        return [], np.zeros((0, 1 << BITS))
    share = np.array([(sums[x] + 0.5) / (sums[x].sum() + 0.5 * (1 << BITS)) for x in langs])
    return langs, np.log(share)


def _scorer(model: np.ndarray, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                data, ends = buffers(part.column(0))
                # Differences to the first language keep long sums exact enough.
                total = np.zeros((part.num_rows, len(model)))
                for low in range(0, len(data), 1 << 20):
                    cut = np.clip(ends - low, 0, min(len(data) - low, (1 << 20) + 2))
                    bins, inside = _trigrams(data[low : low + (1 << 20) + 2], cut)
                    owner = np.searchsorted(ends, low + np.flatnonzero(inside), "right") - 1
                    for k in range(1, len(model)):
                        gain = (model[k] - model[0])[bins[inside]]
                        total[:, k] += np.bincount(owner, gain, part.num_rows)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), len(model)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], lists], names=[*names, "_scores"])

    return score


def _best(scores: Column) -> Column:
    """0-based place of the highest score, the first of equals."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def identify(
    rows: DataFrame,
    langs: list[str],
    model: np.ndarray,
    temper: float = 0.2,
    weight: float = 5.0,
) -> DataFrame:
    """``rows`` without text but with ``lang``, ``confidence`` and ``text_lang``.

    ``rows`` needs text, declared, suffix and host. ``weight`` is how many rows the smoothing of
    a table is worth.
    """
    own = [c for c in rows.columns if c not in EVIDENCE]
    n = len(langs)
    if not n:
        none = F.lit(None).cast("string")
        return rows.select(*own, none.alias("lang"), F.lit(None).cast("double").alias("confidence"), none.alias("text_lang"))
    given = rows.select(F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("_text"), *own, *EVIDENCE[1:])
    fields = given.drop("_text").schema.add("_scores", T.ArrayType(T.DoubleType()))
    scored = given.mapInArrow(_scorer(model, [*own, *EVIDENCE[1:]]), fields)
    scored = store(scored.withColumn("_told", _best(F.col("_scores"))), "langid")
    site = F.coalesce(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.lit(""))
    scored = scored.withColumn("_site", F.when(site != "", site).otherwise(F.col("host")))
    told = [F.sum((F.col("_told") == k).cast("long")) for k in range(n)]
    sums = lambda name: F.array(*told).alias(name)
    everything = [x or 0 for x in scored.agg(*told).first()]
    total = sum(everything)
    share = [(x + 1) / (total + n) for x in everything]

    def table_of(column: str, name: str) -> DataFrame:
        return scored.filter(F.col(column).isNotNull()).groupBy(column).agg(sums(name))

    joined = scored
    for column, name in (("declared", "_d"), ("suffix", "_s"), ("_site", "_n_site"), ("host", "_n_host")):
        joined = joined.join(table_of(column, name), column, "left")
    mine = [(F.col("_told") == k).cast("long") for k in range(n)]
    all_of = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda a, b: a + b) - 1

    def prior(k: int) -> Column:
        count = lambda name: F.col(name)[k] - mine[k]
        upper = (count("_n_site") + weight * share[k]) / (all_of("_n_site") + weight)
        lower = (count("_n_host") + weight * upper) / (all_of("_n_host") + weight)
        return F.coalesce(lower, F.lit(share[k]))

    def likelihood(name: str, k: int) -> Column:
        """Of the value given the language, the row itself left out."""
        value = all_of(name) / max(1, total)
        return F.coalesce((F.col(name)[k] - mine[k] + weight * value + 1e-9) / (F.lit(everything[k]) - mine[k] + weight), F.lit(1.0))

    fused = [
        temper * F.col("_scores")[k] + F.log(prior(k)) + F.log(likelihood("_d", k)) + F.log(likelihood("_s", k))
        for k in range(n)
    ]
    names = F.array(*[F.lit(x) for x in langs])
    out = joined.select(*own, names[F.col("_told")].alias("text_lang"), F.array(*fused).alias("_fused"))
    top = F.array_max("_fused")
    mass = F.aggregate("_fused", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return out.select(*own, names[_best(F.col("_fused"))].alias("lang"), (1 / mass).alias("confidence"), "text_lang")


def page_evidence(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, suffix, host) of raw web pages."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    said = F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    blank = lambda c: F.when(c != "", c)
    return pages.select(
        "page_id",
        bare.alias("text"),
        blank(said).alias("declared"),
        blank(F.regexp_extract(host, r"\.([a-z]+)$", 1)).alias("suffix"),
        blank(host).alias("host"),
    )


@query("op3_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents and all web pages.

    A row has a doc_id or a page_id. Documents have no address; their source is their host.
    """
    docs = table(spark, sf_dir, "documents")
    langs, model = learn(docs.select("doc_id", "lang", "text"))
    none = F.lit(None).cast("string")
    own = docs.select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("page_id"), "text", none.alias("declared"), none.alias("suffix"), F.col("source").alias("host"))
    pages = page_evidence(table(spark, sf_dir, "pages")).select(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long"), *EVIDENCE)
    return identify(own.unionByName(pages), langs, model)
