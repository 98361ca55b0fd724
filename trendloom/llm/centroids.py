"""Clustering of integer vectors around centroids, by dot products that are kept and corrected.

The table of a round holds, beside a vector's integers, its product with itself and its product with
every centroid. When centroids move, a product changes by the moved components alone: those whose
difference is not zero are multiplied, all others are as they were. The nearest centroid follows from
the products, without the vector: |x - c|^2 = x.x - 2 x.c + c.c. All numbers are integers, so a
corrected product equals one computed anew, however many rounds there are.

Each round is a written table. What reaches the driver is a sum per centroid: ``k`` times ``dims``
numbers, added up in every batch and every task first, so that a cluster of any size is a few rows.

Edge cases: vectors of another length, and those with a null or non-finite component, are left out;
of fewer vectors than ``k`` each is a centroid; equal hashes (repeated ids) are ordered by vector;
an id that is null hashes as empty text; repeated rows are vectors each; ties go to the centroid of
the smaller number; centroids without a vector stay where they are; an empty table gives no rows;
other columns are ignored. Components beyond 2^27 after scaling have no exact result in 64 bits and
raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.base import query, store, table

LARGEST = 1 << 27
STATE = "vec_id long, x array<int>, own long, dots array<long>, cluster int, distance long"


def integers(vectors: DataFrame, vector: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """``vec_id`` and ``x``, the whole part of every component times ``scale``; other vectors are left out."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    whole = (F.size("v") == dims) & F.forall("v", finite)

    def part(v: Column) -> Column:
        scaled = F.floor(F.lit(scale) * v)
        fits = F.abs(v) <= LARGEST / scale
        return F.when(fits, scaled.cast("int")).otherwise(F.raise_error(F.lit("component too large for exact products")))

    return rows.filter(F.coalesce(whole, F.lit(False))).select("vec_id", F.transform("v", part).alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """The vectors with the smallest hashes of their ids: at most ``k`` rows reach the driver."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = rows.select(F.sha2(name, 256).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in chosen], np.int64)


def _matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(dtype)


def _state(batch: pa.RecordBatch, x: np.ndarray, own: np.ndarray, dots: np.ndarray, norms: np.ndarray) -> pa.RecordBatch:
    """The rows of a batch with their products and the nearest centroid."""
    far = norms - 2 * dots
    cluster = far.argmin(axis=1)
    distance = own + far[np.arange(len(far)), cluster]
    lists = lambda m, t: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel(), t))
    columns = [batch.column(0), lists(x, pa.int32()), pa.array(own), lists(dots, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance)]
    return pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "own", "dots", "cluster", "distance"])


def _begin(centroids: np.ndarray):
    """Products of integer vectors with every centroid."""
    norms = (centroids**2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), centroids.shape[1], np.int64)
            yield _state(batch, x, (x**2).sum(axis=1), x @ centroids.T, norms)

    return run


def _correct(moves: list[tuple[int, np.ndarray, np.ndarray]], centroids: np.ndarray):
    """Correct the kept products by the components that moved: (centroid, components, differences)."""
    norms = (centroids**2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), centroids.shape[1], np.int64)
            dots = _matrix(batch.column(3), len(centroids), np.int64)
            for number, parts, by in moves:
                dots[:, number] += x[:, parts] @ by
            yield _state(batch, x, batch.column(2).to_numpy(), dots, norms)

    return run


def _added(dims: int):
    """A row per batch and cluster: how many vectors, their sum, and the sum of their distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            order = np.argsort(cluster, kind="stable")
            there, starts, n = np.unique(cluster[order], return_index=True, return_counts=True)
            if not len(there):
                continue
            sums = np.add.reduceat(_matrix(batch.column(1), dims, np.int64)[order], starts)
            spread = np.add.reduceat(distance[order], starts)
            columns = [pa.array(there, pa.int32()), pa.array(n, pa.int64()), pa.array(list(sums), pa.list_(pa.int64())), pa.array(spread)]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums", "spread"])

    return run


def totals(state: DataFrame, dims: int) -> list:
    """(cluster, n, sums, spread), a row per non-empty cluster."""
    parts = state.select("cluster", "x", "distance").mapInArrow(_added(dims), "cluster int, n long, sums array<long>, spread long")
    sums = F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums")
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), sums, F.sum("spread").alias("spread")).collect()


def moved(centroids: np.ndarray, found: list) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """The means, rounded down, and what changed: components that stay are not listed."""
    out = centroids.copy()
    for row in found:
        out[row["cluster"]] = [s // row["n"] for s in row["sums"]]
    moves = []
    for number in range(len(out)):
        by = out[number] - centroids[number]
        parts = np.flatnonzero(by)
        if len(parts):
            moves.append((number, parts, by[parts]))
    return out, moves


def cluster(rows: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """The last table of products (``STATE``) of ``rows`` (``vec_id``, ``x``), and the centroids."""
    rows = store(rows, "integers")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], STATE), centroids.reshape(0, dims)
    state = store(rows.mapInArrow(_begin(centroids), STATE), "products")
    for _ in range(rounds):
        centroids, moves = moved(centroids, totals(state, dims))
        if moves:
            state = store(state.mapInArrow(_correct(moves, centroids), STATE), "products")
    return state, centroids


def described(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """A row per vector: its cluster, the distance, sums of distances and a digest of the centroid."""
    spreads = {r["cluster"]: r["spread"] for r in totals(state, centroids.shape[1])} if len(centroids) else {}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = [(number, spread, sum(spreads.values()), digests[number]) for number, spread in sorted(spreads.items())]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    small = F.broadcast(state.sparkSession.createDataFrame(about, schema))  # a row per centroid
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return state.select("vec_id", "cluster", "distance").join(small, "cluster").select(columns)


def _sql(k: int = 16, rounds: int = 3) -> str:
    parts = [
        """kept AS (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""",
        "xs AS MATERIALIZED (SELECT rid, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM kept)",
        f"""c0 AS MATERIALIZED (
    SELECT c, i, v FROM (SELECT rid, row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), x) - 1 AS c FROM kept) JOIN xs USING (rid) WHERE c < {k}
)""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
    SELECT rid, least_of.c AS cluster, least_of.d AS distance FROM (
        SELECT rid, min(struct_pack(d := d, c := c)) AS least_of FROM (
            SELECT rid, c, CAST(sum((xs.v - c{r}.v) * (xs.v - c{r}.v)) AS BIGINT) AS d FROM xs JOIN c{r} USING (i) GROUP BY rid, c
        ) GROUP BY rid)
)"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
    SELECT c, i, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
        SELECT cluster AS c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS v
        FROM (SELECT cluster, i, sum(v) AS s, count(*) AS n FROM xs JOIN a{r} USING (rid) GROUP BY cluster, i)
    ) m USING (c, i)
)"""
            )
    return (
        "WITH "
        + ", ".join(parts)
        + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (rid)
JOIN (SELECT c AS cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c) USING (cluster)
"""
    )


@query("op13_centroid_clusters", _sql())
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in sixteen clusters after three rounds."""
    return described(*cluster(integers(table(spark, sf_dir, "embeddings"))))
