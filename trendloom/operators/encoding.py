"""A text encoder that is fitted once, stored, and used on any table: hashed TF-IDF.

A token falls into one of ``dim`` buckets by the MD5 of its lower-case text. Fitting counts, per
bucket, the texts that hold one of its tokens: one pass, a row per bucket. A text's vector is the
count of its tokens per bucket times ``ln((texts + 1) / (texts with the bucket + 1))``, at length 1; a
text without a token has the zero vector and null text none. Posts and reference sentences encoded by
one encoder lie in one space, which cosines need.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions import text as tx

SLICE = 1024


def _buckets(text: Column, dim: int, pattern: str) -> Column:
    """The bucket of every token, in order; null text has none."""
    number = lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("bigint")
    return F.transform(tx.tokens(F.lower(text), pattern), lambda w: (number(w) % dim).cast("int"))


@dataclass(frozen=True)
class HashedTfidf:
    """``weights``: per bucket. Calling it with a text column gives the vector column."""

    weights: np.ndarray
    pattern: str = tx.TOKEN_PATTERN

    def __call__(self, text: Column) -> Column:
        weights = self.weights
        dim = len(weights)

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def vectors(buckets: pa.Array) -> pa.Array:
            valid = np.asarray(buckets.is_valid())
            values, done = np.empty((int(valid.sum()), dim)), 0
            for at in range(0, len(buckets), SLICE):
                part = _encode(buckets.slice(at, SLICE), weights)
                values[done : done + len(part)] = part
                done += len(part)
            ends = np.concatenate([[0], np.cumsum(np.where(valid, dim, 0))])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.ravel()), mask=pa.array(~valid))

        return vectors(_buckets(text, dim, self.pattern))

    def save(self, spark: SparkSession, path: str) -> None:
        row = [(self.pattern, self.weights.tolist())]
        spark.createDataFrame(row, "pattern string, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HashedTfidf:
        row = spark.read.parquet(path).first()
        return cls(np.array(row["weights"]), row["pattern"])


def _encode(buckets: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The vectors of the rows that are not null."""
    present = buckets.drop_null()
    dim, n = len(weights), len(present)
    flat = np.asarray(present.flatten(), dtype=np.int64)
    flat = flat + np.repeat(np.arange(n) * dim, np.asarray(present.value_lengths()))
    matrix = np.bincount(flat, minlength=n * dim).reshape(n, dim) * weights
    norms = np.sqrt((matrix**2).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=matrix, where=norms > 0)


def fit(df: DataFrame, column: str = "text", dim: int = 512, pattern: str = tx.TOKEN_PATTERN) -> HashedTfidf:
    """The encoder of the texts of a table; ``dim`` numbers reach the driver."""
    own = df.select(F.array_distinct(_buckets(F.col(column), dim, pattern)).alias("b")).filter(F.col("b").isNotNull())
    # One row per bucket, and one under the number -1 that counts the texts.
    counted = own.select(F.explode(F.concat(F.array(F.lit(-1)), "b")).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    found = {r["b"]: r["n"] for r in counted.collect()}
    held = np.array([found.get(i, 0) for i in range(dim)], np.float64)
    return HashedTfidf(np.log((found.get(-1, 0) + 1) / (held + 1)), pattern)
