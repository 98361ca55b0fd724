"""A dataset manifest as a content-addressed DAG of digests, and proofs that rows belong to it.

Every row is a leaf: the digest of its fields, each as its length and value. The leaves of a
language, in ascending order of their ids, are cut into runs of ``FANOUT``; the digest of a run is
a node, and so on up to one digest a language and, over the languages in order, one root. What is
stored is a record per node: its digest and those of its children, a table per height.

A proof is found by descent. From the root, the digits of a leaf's rank in base ``FANOUT`` say which
child to follow; the others, left and right of it, are a segment of the proof. Leaves that share a
prefix of digits descend together as one row, so a step touches each node once and only the last
meets rows, a run of at most ``FANOUT`` at a time. Reversed, the segments lead from the leaf up.

Ranks are made without gathering a language: rows are sorted in ranges, and only the number of rows
per range and language is added up. No step groups more than ``FANOUT`` rows under one key.

Edge cases: null fields count as ``-``, so null and empty texts differ; rows without an id come
first in their language and those without a language form the first tree; equal ids are ordered by
digest and equal rows are leaves each; an empty table has no root and no proofs; other columns are
ignored. Texts of any length are hashed whole. Changes to a row without an id are never simulated.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendloom.llm.base import query, store, table

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WORKING = ("tree", "idx", "size", "subroot", "path", "_at", "_range", "_group", "_r", "_g", "_shift", "_lang", "_trees", "_run", "_children", "_path")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row."""
    return F.sha2(F.concat(*map(field, fields)), 256)


def _numbered(df: DataFrame, order: Sequence[str], group: str | None = None) -> DataFrame:
    """``df`` with ``idx``, the rank in ``order`` (within ``group``), and ``size``, the rows ranked.

    ``group`` must lead ``order``. Sorted ranges are written; what is added up is a row per range
    and group that it touches, and nothing but a range is ever joined under one key.
    """
    names = df.columns
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = store(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    own = F.col(group) if group else F.lit(0)
    ranged = ranged.withColumn("_group", own)
    ranges = ranged.groupBy("_range", "_group").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    ordered = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        F.col("_range").alias("_r"),
        F.col("_group").alias("_g"),
        (F.coalesce(F.sum("_n").over(ordered), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("_group")).alias("size"),
    )
    here = (F.col("_range") == F.col("_r")) & F.col("_group").eqNullSafe(F.col("_g"))
    return ranged.join(starts, here).select(*names, (F.col("_at") + F.col("_shift")).alias("idx"), "size")


@dataclass(frozen=True)
class Tree:
    """``heights[k]``: the records (digest, children) of height k + 1. ``roots``: (tree, size, height, digest)."""

    heights: list[DataFrame]
    roots: DataFrame


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the rows with their ``tree`` and ``idx``; ``root``: None for an empty table."""

    leaves: DataFrame
    trees: Tree
    top: Tree
    root: str | None


def _grow(level: DataFrame, name: str) -> Tree:
    """All heights over ``level``, whose rows are (tree, size, idx, digest)."""
    largest = level.agg(F.max("size")).first()[0] or 0
    roots, heights = [], []
    level = level.select("tree", F.col("size").alias("all"), "size", "idx", "digest")
    while True:
        done = level.filter("size = 1")
        roots.append(done.select("tree", F.col("all").alias("size"), F.lit(len(heights)).alias("height"), "digest"))
        if largest <= 1:
            break
        runs = (
            level.filter("size > 1")
            .groupBy("tree", "all", "size", F.floor(F.col("idx") / FANOUT).alias("idx"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col("idx").alias("at"), "digest"))).alias("run"))  # FANOUT at most
            .select("tree", "all", F.ceil(F.col("size") / FANOUT).alias("size"), "idx", F.col("run.digest").alias("children"))
            .withColumn("digest", F.sha2(F.array_join("children", ""), 256))
        )
        level = store(runs, name)
        heights.append(level.groupBy("digest").agg(F.any_value("children").alias("children")))
        largest = -(-largest // FANOUT)
    out = roots[0]
    for other in roots[1:]:
        out = out.unionByName(other)
    return Tree(heights, store(out, name + "-roots"))


def build(leaves: DataFrame) -> Manifest:
    """The manifest of rows with ``doc_id``, ``lang`` and ``leaf``; other columns are kept, but for ``WORKING``."""
    leaves = leaves.drop(*WORKING)
    placed = _numbered(leaves, ["lang", "doc_id", "leaf"], "lang")
    langs = _numbered(leaves.groupBy("lang").agg(F.count("*").alias("n")), ["lang"])
    langs = langs.select(F.col("lang").alias("_lang"), F.col("idx").alias("tree"), F.col("size").alias("_trees"))
    placed = store(placed.join(langs, F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang"), "leaves")
    trees = _grow(placed.select("tree", "size", "idx", F.col("leaf").alias("digest")), "nodes")
    counts = placed.groupBy("tree").agg(F.any_value("_trees").alias("size"))
    subroots = trees.roots.drop("size", "height").join(counts, "tree")
    top = _grow(subroots.select(F.lit(0).alias("tree"), "size", F.col("tree").alias("idx"), "digest"), "top")
    root = top.roots.first()
    return Manifest(placed.drop("_trees"), trees, top, root["digest"] if root else None)


def _descend(frontier: DataFrame, records: DataFrame, height: int) -> DataFrame:
    """Replace the nodes of ``height`` by their children; lower ones stay."""
    here = frontier.filter(F.col("height") == height).join(records, "digest")
    steps = here.select("*", F.posexplode("children").alias("pos", "child"))
    segment = F.struct(
        F.array_join(F.slice("children", F.lit(1), F.col("pos")), "").alias("before"),
        F.array_join(F.slice("children", F.col("pos") + 2, F.lit(FANOUT)), "").alias("after"),
    )
    below = steps.select(
        F.col("child").alias("digest"),
        "tree",
        (F.col("idx") * FANOUT + F.col("pos")).alias("idx"),
        (F.col("height") - 1).alias("height"),
        "subroot",
        F.concat("path", F.array(segment)).alias("path"),
    )
    return below.unionByName(frontier.filter(F.col("height") < height))


PATH = "array<struct<before string, after string>>"


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """The leaves with ``subroot`` and ``path``, their segments from the leaf up to the root.

    ``wanted`` holds the rows of ``manifest.leaves`` to prove; without it all are, and no branch
    is passed over. The path of a row has one segment a level.
    """
    rows = manifest.leaves if wanted is None else wanted
    if manifest.root is None:
        return rows.select("*", F.lit(None).cast("string").alias("subroot"), F.array().cast(PATH).alias("path"))
    spark = rows.sparkSession
    at = "digest string, tree long, idx long, height int, subroot string, path " + PATH
    top_height = len(manifest.top.heights)
    frontier = spark.createDataFrame([(manifest.root, 0, 0, top_height, None, [])], at)
    for height in range(top_height, 0, -1):
        frontier = store(_descend(frontier, manifest.top.heights[height - 1], height), "frontier")
    entry = manifest.trees.roots.select("tree", F.col("height").alias("h"))
    frontier = frontier.select(F.col("idx").alias("tree"), "digest", "path").join(entry, "tree").select(
        "digest", "tree", F.lit(0).cast("long").alias("idx"), F.col("h").alias("height"), F.col("digest").alias("subroot"), "path"
    )
    for height in range(len(manifest.trees.heights), 1, -1):
        frontier = _descend(frontier, manifest.trees.heights[height - 1], height)
        if wanted is not None:
            step = FANOUT ** (height - 1)
            asked = rows.select("tree", F.floor(F.col("idx") / step).alias("idx"), F.lit(height - 1).alias("height")).distinct()
            frontier = frontier.join(asked, ["tree", "idx", "height"], "left_semi").unionByName(
                frontier.filter(F.col("height") < height - 1)
            )
        frontier = store(frontier, "frontier")
    runs = frontier
    if manifest.trees.heights:
        runs = frontier.join(manifest.trees.heights[0].withColumnRenamed("children", "_children"), "digest", "left")
    else:
        runs = frontier.withColumn("_children", F.lit(None).cast("array<string>"))
    runs = runs.select("tree", F.col("idx").alias("_run"), "_children", "subroot", F.col("path").alias("_path"))
    pos = F.pmod("idx", F.lit(FANOUT)).cast("int")
    last = F.struct(
        F.array_join(F.slice("_children", F.lit(1), pos), "").alias("before"),
        F.array_join(F.slice("_children", pos + 2, F.lit(FANOUT)), "").alias("after"),
    )
    whole = F.when(F.col("_children").isNull(), F.col("_path")).otherwise(F.concat("_path", F.array(last)))
    joined = rows.withColumn("_run", F.floor(F.col("idx") / FANOUT)).join(runs, ["tree", "_run"])
    return joined.withColumn("path", F.reverse(whole)).drop("_run", "_children", "_path")


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _tampered(text: Column, doc_id: Column) -> Column:
    chosen = F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))
    return F.when(chosen, F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(text)


SQL = """
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
), rows_in AS (
    SELECT row_number() OVER () AS rid, doc_id, source, lang, n_chars, text,
           xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 AS chosen
    FROM documents, crc_table
), fields AS (
    SELECT rid, doc_id, lang, coalesce(chosen, false) AS chosen,
           concat(coalesce(concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id), '-'), coalesce(concat(strlen(source), ':', source), '-'),
                  coalesce(concat(strlen(lang), ':', lang), '-'), coalesce(concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars), '-')) AS head,
           text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
    FROM rows_in
), digests AS (
    SELECT rid, doc_id, lang, sha256(concat(head, coalesce(concat(strlen(text), ':', text), '-'))) AS leaf,
           sha256(concat(head, coalesce(CASE WHEN chosen THEN concat(strlen(low), ':', low) ELSE concat(strlen(text), ':', text) END, '-'))) AS given
    FROM fields
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM digests
), nodes(lang, lvl, idx, digest) AS (
    SELECT lang, 0, idx, leaf FROM placed
    UNION ALL
    SELECT lang, lvl + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM nodes) WHERE n > 1 GROUP BY lang, lvl, idx // 8
), subroots AS (
    SELECT lang, lvl AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY lvl DESC) AS k FROM nodes) WHERE k = 1
), top(lvl, idx, digest) AS (
    SELECT 0, idx, subroot FROM subroots
    UNION ALL
    SELECT lvl + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY lvl, idx // 8
), root AS (SELECT digest AS root, lvl AS height FROM top ORDER BY lvl DESC LIMIT 1),
own_steps AS (
    SELECT p.rid, n.lvl, string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx < p.idx // (8 ** n.lvl)::BIGINT) AS before,
           string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx > p.idx // (8 ** n.lvl)::BIGINT) AS after
    FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
    JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.lvl < s.height AND n.idx // 8 = p.idx // (8 ** (n.lvl + 1))::BIGINT
    GROUP BY p.rid, n.lvl
), top_steps AS (
    SELECT s.lang, n.lvl, string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx < s.idx // (8 ** n.lvl)::BIGINT) AS before,
           string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx > s.idx // (8 ** n.lvl)::BIGINT) AS after
    FROM subroots s CROSS JOIN root JOIN top n ON n.lvl < root.height AND n.idx // 8 = s.idx // (8 ** (n.lvl + 1))::BIGINT
    GROUP BY s.lang, n.lvl
), steps AS (
    SELECT rid, lvl, before, after FROM own_steps
    UNION ALL
    SELECT p.rid, 1000 + t.lvl, before, after FROM placed p JOIN top_steps t ON t.lang IS NOT DISTINCT FROM p.lang
), paths AS (
    SELECT rid, list(concat(before, '|', after) ORDER BY lvl) AS path FROM steps GROUP BY rid
)
SELECT doc_id, leaf, subroot, root,
       sha256(coalesce(replace(array_to_string(path, ''), '|', ''), '')) AS proof_sha256,
       list_reduce(list_concat([given], coalesce(path, [])), lambda a, s: sha256(concat(split_part(s, '|', 1), a, split_part(s, '|', 2)))) AS folded_root,
       list_reduce(list_concat([given], coalesce(path, [])), lambda a, s: sha256(concat(split_part(s, '|', 1), a, split_part(s, '|', 2)))) = root AS verified
FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN root LEFT JOIN paths USING (rid)
"""


@query("op11_merkle_manifest", SQL)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of all documents, and every row, some of them changed, checked against it."""
    return checked(table(spark, sf_dir, "documents"))


def checked(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, proof and the outcome of the check for every row of ``docs``."""
    columns = {name: F.col(name) for name in FIELDS}
    given = columns | {"text": _tampered(columns["text"], columns["doc_id"])}
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", leaf(columns.values()).alias("leaf"), leaf(given.values()).alias("given")
    )
    manifest = build(store(leaves, "digests"))
    proven = prove(manifest).withColumn("folded_root", fold(F.col("given"), F.col("path")))
    root = F.lit(manifest.root).cast("string")
    return proven.select(
        "doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == root).alias("verified"),
    )
