"""Exact similarity join of word-shingle sets by a token-group matrix.

Copies of a set are joined as one. Sets are put into groups of similar ones: first by least hash
and class of size, then each such group moves to the one that most of its prefix tokens name (the
least group that holds the token). Groups of many sets are dealt into groups of bounded size. The
matrix holds, for each group, the union of its members' prefixes: of a set of n tokens the
n - ceil(t * n) + l that come first in one global order. Two sets with Jaccard similarity t or more
share at least l tokens of their prefixes (l being the lesser of theirs), so a set is a query to
those other groups only whose union holds as many of its own. An opened group is indexed by token;
queries whose overlap with the whole union of its tokens reaches t * n are compared with its
members, exactly.

The global order puts rare tokens first, as far as a count sketch of fixed size tells; the sketch
covers all texts, and the result does not depend on it. So a passage that a third of all texts
share stands at the end of their orders and pairs none of them by itself.

Groups are first compared inside. Sets that this puts into one component are not compared again.
A crowd of texts that are alike without linking lies in few groups, so rows that are joined grow
with the crowd, and with its square only in steps of a group's size. Only a spanning set of links
leaves a task, and components follow from those. Nothing is capped.

Edge cases: null text and text without words have the empty set and link with nothing; repeated
rows are copies; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendloom.llm.base import query, store, table
from trendloom.llm.components import components
from trendloom.llm.shingles import mix, sets, signature

GROUP_ROWS = 1024
GROUP_TOKENS = 1 << 20
SALTS = 64
PROFILE = "doc_id long, n long, s1 long, s2 long, least long, sketch binary"


def _signed(values: list[int]) -> pa.Array:
    return pa.array(values, pa.int64())


def _profiles(k: int, bits: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, some = np.zeros(1 << bits, np.uint32), False
        schema = pa.schema([(x.split()[0], {"long": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for x in PROFILE.split(", ")])
        for batch in batches:
            rows = []
            for own in sets(batch.column(1), k):
                np.add.at(sketch, (own & np.uint64((1 << bits) - 1)).astype(np.int64), 1)
                least = int(own[:1].view(np.int64)[0]) if len(own) else 0
                rows.append((len(own), *signature(own), least))
            if rows:
                some = True
                columns = [_signed(x) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.nulls(len(rows), pa.binary())], schema=schema)
        if some:
            none = pa.nulls(1, pa.int64())
            packed = pa.array([zlib.compress(sketch.astype(np.uint64).tobytes(), 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([none, none, none, none, none, packed], schema=schema)

    return profile


def _prefixes(k: int, bits: int, percent: int, extra: int, shared):
    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            firsts, marks = [], []
            for own in sets(batch.column(1), k):
                n = len(own)
                size = n - -(-percent * n // 100) + slack(n, extra) if n else 0
                rank = level[(own & np.uint64((1 << bits) - 1)).astype(np.int64)]
                firsts.append(own[np.argsort(rank, kind="stable")[:size]].view(np.int64))
                marks.append(signature(own)[0])
            ends = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*firsts, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), _signed(marks), tokens], ["rep", "s1", "tokens"])

    return prefix


def slack(n: int, extra: int) -> int:
    """l of a set of n tokens: how many shared prefix tokens a link must have."""
    return max(1, n * extra // 100)


def _links(k: int, percent: int):
    """Verify units: a group by itself, or one and the queries sent to it. Rows of a unit follow
    each other; rows with the same label are known to be linked."""

    def open_unit(rows: list[tuple[int, int, int, int, np.ndarray]]) -> Iterator[tuple[int, int]]:
        members = {}
        for side, rep, mark, label, own in rows:
            if signature(own)[0] == mark:  # else another text under the same id
                members[(rep, mark)] = (side, label, own)
        first: dict[int, tuple[int, int]] = {}
        root = {m: first.setdefault(label, m) for m, (_, label, _) in sorted(members.items())}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        queries, others = ([m for m in root if members[m][0] == side] for side in (0, 1))
        alone = not others
        if alone:
            others = queries
        tokens = np.concatenate([np.zeros(0, np.uint64), *(members[m][2] for m in others)])
        sizes = np.array([len(members[m][2]) for m in others], np.int64)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], np.repeat(np.arange(len(others)), sizes)[order]
        for i, q in enumerate(queries):
            own = members[q][2]
            low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
            held = high - low
            if 100 * np.count_nonzero(held) < percent * len(own):
                continue
            at = np.arange(held.sum()) + np.repeat(low - np.cumsum(held) + held, held)
            both = np.bincount(owner[at], minlength=len(others))
            near = 100 * both >= percent * (len(own) + sizes - both)
            if alone:
                near[i:] = False
            for j in np.flatnonzero(near).tolist():
                if find(q) != find(others[j]):
                    root[find(q)] = find(others[j])
                    yield q[0], others[j][0]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows, out = None, [], []
        for batch in batches:
            a, b, side, rep, mark, label = (batch.column(i).to_pylist() for i in range(6))
            for i, own in enumerate(sets(batch.column(6), k)):
                if (a[i], b[i]) != unit:
                    out += open_unit(rows)
                    unit, rows = (a[i], b[i]), []
                rows.append((side[i], rep[i], mark[i], label[i], own))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([_signed(x) for x in zip(*out, strict=True)], ["a", "b"])
                out = []
        out += open_unit(rows)
        if out:
            yield pa.RecordBatch.from_arrays([_signed(x) for x in zip(*out, strict=True)], ["a", "b"])

    return verify


def join(
    docs: DataFrame, percent: int = 80, k: int = 5, extra: int = 5, sketch_bits: int = 22
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, rep, component_id) and links (a, b) between representatives.

    ``rep`` is the least id with the same set. The links span every component; links that others
    imply may be left out. ``sketch_bits`` should grow with the logarithm of the collection.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    profiles = store(texts.mapInArrow(_profiles(k, sketch_bits), PROFILE), "profiles")
    level = _levels(profiles.filter("sketch IS NOT NULL"), sketch_bits)
    rows = profiles.filter("sketch IS NULL").drop("sketch")
    size_class = F.floor(F.log("n") / F.log(F.lit(1.25)))
    reps = (
        rows.filter("n > 0")
        .groupBy("n", "s1", "s2", "least")
        .agg(F.min("doc_id").alias("rep"))
        .withColumn("size_class", size_class)
    )
    reps = store(_dealt(reps, "least", "s1"), "reps")
    shared = spark.sparkContext.broadcast(level)
    firsts = texts.mapInArrow(_prefixes(k, sketch_bits, percent, extra, shared), "rep long, s1 long, tokens array<long>")
    by_token = Window.partitionBy("token")
    postings = (
        firsts.join(reps.select("rep", "s1", "group", "n"), ["rep", "s1"])
        .select(F.explode("tokens").alias("token"), "rep", "s1", "n", "group")
        .withColumn("low", F.min("group").over(by_token))
        .withColumn("high", F.max("group").over(by_token))
        .filter("low <> high")
        .drop("high")
    )
    postings = store(postings, "postings")
    home = reps.join(_named(postings), "group", "left").withColumn("home", F.coalesce("home", "group"))
    own = store(_dealt(home.withColumn("size_class", size_class), "home", "group").select("rep", "n", "s1", "s2", "group"), "groups")
    verify = lambda needed, name: store(_opened(texts, needed).mapInArrow(_links(k, percent), "a long, b long"), name)
    rows_of = own.groupBy("group").agg(F.count("*").alias("rows"))
    inside = own.join(rows_of.filter("rows > 1"), "group")
    links = verify(inside.select(F.lit(0).alias("part"), "group", F.lit(0).alias("side"), "rep", "s1", F.col("rep").alias("label")), "near-links")
    known = components(links).select(F.col("node").alias("rep"), F.col("component").alias("label"))
    own = own.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    whole = own.groupBy("group").agg(F.min("label").alias("one"), F.max("label").alias("other"), F.count("*").alias("rows"))
    whole = whole.select("group", F.when(F.col("one") == F.col("other"), F.col("one")).alias("one"), "rows")
    own = store(own.select("rep", "s1", "group", "label").join(whole, "group"), "labelled")
    asked = store(_asked(postings.select("token", "rep", "s1", "n").join(own, ["rep", "s1"]), percent, extra), "asked")
    links = links.unionByName(verify(_queries(asked, own), "far-links"))
    found = components(links)
    labelled = reps.select("n", "s1", "s2", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    out = rows.join(labelled, ["n", "s1", "s2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("rep", "doc_id").alias("rep"),
        F.coalesce("component", "rep", "doc_id").alias("component_id"),
    )
    return out, links


def _dealt(reps: DataFrame, alike: str, by: str) -> DataFrame:
    """Add ``group``: sets with the same ``alike`` and class of size, dealt by ``by`` where they are
    many. Only crowds are looked up, and sets are salted for it, so that none meets in one task."""
    wide = reps.groupBy(alike, "size_class").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    parts = F.ceil(F.greatest(F.col("rows") / GROUP_ROWS, F.col("tokens") / GROUP_TOKENS)).alias("parts")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    crowds = wide.select(alike, "size_class", parts).filter("parts > 1").select("*", salts)
    salted = reps.withColumn("salt", F.pmod(F.xxhash64("s1", "rep"), F.lit(SALTS)).cast("int"))
    dealt = salted.join(crowds, [alike, "size_class", "salt"], "left")
    group = F.xxhash64(alike, "size_class", F.pmod(F.xxhash64(by), F.coalesce("parts", F.lit(1))))
    return dealt.withColumn("group", group).drop("size_class", "parts", "salt")


def _named(postings: DataFrame) -> DataFrame:
    """(group, home): the group that most of a group's tokens name, maybe itself. A token names the
    least group that holds it, so texts that are alike meet without pairing all their groups."""
    votes = postings.groupBy("group", "low").count()
    best = votes.groupBy("group").agg(F.max(F.struct("count", "low")).alias("best"))
    return best.select("group", F.col("best.low").alias("home"))


def _asked(postings: DataFrame, percent: int, extra: int) -> DataFrame:
    """(rep, s1, label, opened): the groups that a set must be compared with. Of two groups, sets of
    the smaller ask the larger. A group whose members all lie in the set's own component, which
    ``one`` names, need not be opened for it."""
    by_token = Window.partitionBy("token")
    kind = F.coalesce("one", "group")
    mixed = postings.withColumn("low", F.min(kind).over(by_token)).withColumn("high", F.max(kind).over(by_token))
    mixed = store(mixed.filter("low <> high").drop("low", "high"), "mixed")
    matrix = mixed.groupBy("token", "group", "one", "rows").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    matrix = matrix.withColumnsRenamed({"group": "opened", "one": "other", "rows": "many"})
    asks = F.struct("rows", "group") < F.struct("many", "opened")
    close = (100 * F.col("n") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("n"))
    apart = F.coalesce(F.col("label") != F.col("other"), F.lit(True))
    needed = F.greatest(F.lit(1), F.floor(F.least(F.min("n"), F.min("least")) * extra / 100))
    return (
        mixed.join(matrix, "token")
        .filter(asks & close & apart)
        .groupBy("rep", "s1", "label", "opened")
        .agg(F.count("*").alias("shared"), needed.alias("needed"))
        .filter("shared >= needed")
        .drop("shared", "needed")
    )


def _queries(asked: DataFrame, own: DataFrame, crowd: int = 4096) -> DataFrame:
    """(part, group, side, rep, s1, label): each opened group with its members (side 1) and its
    queries (side 0), in parts of about ``crowd`` queries."""
    wide = asked.groupBy("opened").agg(F.ceil(F.count("*") / crowd).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    sent = asked.join(wide, "opened").select(part.alias("part"), F.col("opened").alias("group"), F.lit(0).alias("side"), "rep", "s1", "label")
    parts = wide.select(F.col("opened").alias("group"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    held = parts.join(own, "group").select("part", "group", F.lit(1).alias("side"), "rep", "s1", "label")
    return sent.unionByName(held)


def _opened(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """The texts of units, those of a unit one after the other."""
    return (
        texts.withColumnRenamed("doc_id", "rep")
        .join(needed, "rep")
        .select("part", "group", "side", "rep", "s1", "label", "text")
        .repartition("part", "group")
        .sortWithinPartitions("part", "group")
    )


def _added(a: bytes | None, b: bytes | None) -> bytes | None:
    """The sum of two packed rows of 64-bit counters; packed, they are small on their way."""
    if a is None or b is None:
        return a if b is None else b
    both = np.frombuffer(zlib.decompress(a), np.uint64) + np.frombuffer(zlib.decompress(b), np.uint64)
    return zlib.compress(both.tobytes(), 1)


def _levels(sketches: DataFrame, bits: int) -> np.ndarray:
    """The base-2 logarithm of each counter of the summed sketches."""
    packed = sketches.select("sketch").rdd.map(lambda r: bytes(r["sketch"])).treeAggregate(None, _added, _added, depth=4)
    if packed is None:
        return np.zeros(1 << bits, np.uint8)
    total = np.frombuffer(zlib.decompress(packed), np.uint64)
    return np.frexp(total.astype(np.float32))[1].astype(np.uint8)


@query("op7_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five-word shingles, similarity 0.8."""
    out, _ = join(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")
