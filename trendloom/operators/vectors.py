"""Text vectors and their similarity to reference vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions import text as tx
from trendloom.operators import neighbours, skew

# Reference vectors that one scoring function carries, and that a table is collected up to.
BLOCK = 4096
# Vectors that are scored at once.
SLICE = 1024


def encoder(load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 100):
    """A user's text encoder as a column function. ``load`` runs once per Python worker."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            rows: list[np.ndarray] = []
            for at in range(0, len(texts), batch):
                part = texts.iloc[at : at + batch].fillna("").tolist()
                rows.extend(np.asarray(model(part), dtype=np.float32))
            yield pd.Series(rows)

    return encode


def embed(
    df: DataFrame,
    column: str = "text",
    encode: Callable[[Column], Column] | None = None,
    out: str = "embedding",
    dim: int = 256,
    once_per_text: bool = False,
) -> DataFrame:
    """Add a vector per text: the user's encoder, or hashed TF-IDF of unit length.

    ``once_per_text`` encodes each different text one time and joins the vectors back; that
    pays when the encoder costs more than a shuffle of the text.
    """
    if encode is None:
        return _hashed_tfidf(df, column, out, dim)
    if not once_per_text:
        return df.withColumn(out, encode(F.col(column)))
    vectors = df.select(column).distinct().withColumn(out, encode(F.col(column)))
    return skew.lookup(df, vectors, [column], df.columns, "left")


def _hashed_tfidf(df: DataFrame, column: str, out: str, dim: int) -> DataFrame:
    prepared = df.withColumn("_tokens", tx.tokens(F.lower(F.coalesce(F.col(column), F.lit("")))))
    stages = [
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0),
    ]
    model = Pipeline(stages=stages).fit(prepared)
    return (
        model.transform(prepared)
        .withColumn(out, vector_to_array("_unit", "float32"))
        .drop("_tokens", "_tf", "_tfidf", "_unit")
    )


def centroid(df: DataFrame, column: str = "embedding", by: Sequence[str] = ()) -> DataFrame:
    """Element-wise mean, of the whole table or per group. One running mean per task."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col(column))))
    rows = df.filter(F.col(column).isNotNull())
    return (rows.groupBy(*by) if by else rows).agg(mean.alias(column))


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1; a zero row stays zero, so its similarity is 0."""
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _as_matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the non-null rows, their vectors) straight from Arrow memory."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    valid = np.flatnonzero(np.asarray(column.is_valid()))
    present = column.drop_null()
    flat = np.asarray(present.flatten(), dtype=np.float64)
    lengths = np.asarray(pc.list_value_length(present))
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError(f"vectors of {lengths.min()} to {lengths.max()} numbers in one column")
    return valid, flat.reshape(len(valid), -1) if len(valid) else flat.reshape(0, 0)


def max_cosine(references: np.ndarray) -> Callable[[Column], Column]:
    """Column function: the highest cosine of a vector to any row of ``references``."""
    refs = _unit(np.atleast_2d(np.asarray(references, dtype=np.float64))).T

    @F.arrow_udf(T.DoubleType())
    def score(vectors: pa.Array) -> pa.Array:
        out = np.full(len(vectors), np.nan)
        for at in range(0, len(vectors), SLICE):
            valid, matrix = _as_matrix(vectors.slice(at, SLICE))
            if len(valid):
                out[at + valid] = (_unit(matrix) @ refs).max(axis=1)
        return pa.array(out, mask=np.isnan(out))

    return score


def max_similarity(
    df: DataFrame,
    references: DataFrame | np.ndarray,
    column: str = "embedding",
    out: str = "tech_similarity",
    block: int = BLOCK,
) -> DataFrame:
    """Add the highest cosine to any reference vector; the n x m scores are never written.

    Up to ``block`` reference rows, counted first, travel to the tasks as one matrix. A larger
    table stays a table: its rows lie in cells, of which a vector opens those that can hold its
    best (see ``neighbours.max_cosine``). A larger array goes in blocks.
    """
    if isinstance(references, DataFrame):
        given = references.select(column).filter(F.col(column).isNotNull())
        few = [np.asarray(row[0], dtype=np.float64) for row in given.limit(block + 1).collect()]
        if not few:
            raise ValueError("no reference vectors")
        if len(few) > block:
            return neighbours.max_cosine(df, references, column, out)
        references = np.stack(few)
    blocks = [references[at : at + block] for at in range(0, len(references), block)]
    scores = [max_cosine(b)(F.col(column)) for b in blocks]
    return df.withColumn(out, F.greatest(*scores) if len(scores) > 1 else scores[0])


def centroid_similarity(
    df: DataFrame,
    references: DataFrame,
    column: str = "embedding",
    out: str = "tech_similarity",
) -> DataFrame:
    """Add the cosine to the mean of the raw reference vectors; a zero vector scores 0."""
    return max_similarity(df, centroid(references, column), column, out)


def score_cross(
    df: DataFrame, references: np.ndarray, names: Sequence, column: str = "embedding"
) -> DataFrame:
    """Add one array column of (reference, score), scored in one matrix product per batch."""
    refs = _unit(np.atleast_2d(np.asarray(references, dtype=np.float64))).T

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def score(vectors: pa.Array) -> pa.Array:
        rows: list[list[float] | None] = [None] * len(vectors)
        valid, matrix = _as_matrix(vectors)
        if len(valid):
            for at, scores in zip(valid, (_unit(matrix) @ refs).tolist()):
                rows[at] = scores
        return pa.array(rows, pa.list_(pa.float64()))

    labels = F.array(*[F.lit(n) for n in names])
    return df.withColumn(
        "scores",
        F.transform(
            F.arrays_zip(labels.alias("ref"), score(F.col(column)).alias("score")),
            lambda s: F.struct(s["ref"].alias("ref"), s["score"].alias("score")),
        ),
    )
