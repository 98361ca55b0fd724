"""From raw documents to token ids: quality, near-duplicates, benchmark leaks, secrets, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's ``docs``. All but the last return the columns of ``documents``. No
stage has SQL that gives its rows, so the pipeline is tested against a brute-force version.

Documents may have further columns of any name; what a stage adds gets a name that is free.
Rows without an id cannot be told apart by the near-duplicate stage and stay; null texts are
empty and fail the quality rules; repeated rows share their fate, but of copies one stays, and of several texts of one id the least.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import decontam, jaccard, pieces, quality, secrets
from trendloom.llm.base import free, store, table
from trendloom.llm.records import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return quality.passing(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each component of similar ones."""
    found, _ = jaccard.join(docs)
    first = found.filter("doc_id = component_id").select("doc_id").distinct()
    known = docs.join(first, docs["doc_id"].cast("long") == first["doc_id"], "left_semi")
    named = [F.col(f"`{c}`") for c in docs.columns]
    ordered = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("array", "map", "struct", "variant"))]
    # Of several rows of one id the least stays; each task keeps one before rows are moved.
    one = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(F.struct(*named), F.struct(*ordered)).alias("_row"))
    return one.select("_row.*").unionByName(docs.filter("doc_id IS NULL"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and ``n_chars`` counted anew."""
    clean = secrets.redact(docs, store(secrets.scan(docs), "ledger"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids; the text is what the ids decode to."""
    ids, decoded, lossless = (free(name, docs.columns) for name in ("piece_ids", "decoded", "lossless"))
    encoded = pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"), ids=ids, decoded=decoded)
    same = F.col(decoded) == F.coalesce("text", F.lit(""))
    return encoded.withColumn(lossless, same).withColumn("text", F.col(decoded)).drop(decoded)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("secret scans", secret_scan),
    ("SentencePiece encoding and decoding", piece_ids),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return docs
