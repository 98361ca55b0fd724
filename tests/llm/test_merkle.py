import hashlib
import string
import zlib
from itertools import groupby

import pytest

from trendloom.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, idx int, tree int, path int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    named = (row[0], row[3], row[2], row[4], row[1])
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in named])


def tree(leaves):
    """(root, {place: siblings on every level}) of a list of digests."""
    paths = {i: [] for i in range(len(leaves))}
    level, at = leaves, {i: i for i in paths}
    while len(level) > 1:
        for i, k in at.items():
            first = k // 8 * 8
            paths[i].append((level[first:k], level[k + 1 : first + 8]))
            at[i] = k // 8
        level = [sha(*level[j : j + 8]) for j in range(0, len(level), 8)]
    return level[0], paths


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf(r)))
    trees = [list(g) for _, g in groupby(rows, key=lambda r: r[2])]
    built = [tree([leaf(r) for r in t]) for t in trees]
    root, above = tree([b[0] for b in built])
    out = []
    for t, own in enumerate(trees):
        for i, r in enumerate(own):
            path = built[t][1][i] + above[t]
            given = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                given[1] = r[1].translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
            folded = leaf(given)
            for before, after in path:
                folded = sha(*before, folded, *after)
            proof = sha(*[d for before, after in path for d in before + after])
            out.append((r[0], leaf(r), built[t][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def rows_of(n):
    langs = ["en"] * 12 + ["de", "ž", "Z", None, "lone"]
    out = [(i, f"Text {i} É", langs[i % 17] if i % 17 != 16 or i == 16 else "en", "s", i) for i in range(n)]
    out += [(3, "Same Id", "en", None, 1), (3, "Same Id", "en", None, 1), (None, "No Id", "en", "s", None), (None, "", None, "s", 2)]
    return out + [(900, None, "fr", None, None), (901, "", "fr", "", 0), (902, "LONG " * 40_000, "fr", "s", 5)]


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.checked(df).collect()), key=str)


@pytest.mark.parametrize("n", [90, 600])
def test_manifest_equals_brute_force(spark, n):
    rows = rows_of(n)
    found = got(spark, rows)
    assert found == brute(rows)
    assert {True, False} == {r[-1] for r in found}


def test_small_manifests(spark):
    for rows in ([(1, "A", "en", "s", 1)], [(i, "a", None, None, None) for i in range(9)], [(i, "B", str(i), "s", 1) for i in range(10)]):
        assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_equal_rows_share_records(spark):
    rows = [(None, "same", "en", "s", 1)] * 130
    assert got(spark, rows) == brute(rows)
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    manifest = merkle.build(df.withColumn("leaf", merkle.leaf([merkle.F.col(f) for f in merkle.FIELDS])))
    assert [h.count() for h in manifest.trees.heights] == [2, 2, 1]  # 16 full runs are one record


def test_some_leaves_are_proven(spark):
    rows = rows_of(300)
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    manifest = merkle.build(df.withColumn("leaf", merkle.leaf([merkle.F.col(f) for f in merkle.FIELDS])).select("doc_id", "lang", "leaf"))
    wanted = manifest.leaves.filter("doc_id IN (16, 44, 140)")
    proven = merkle.prove(manifest, wanted).withColumn("folded", merkle.fold(merkle.F.col("leaf"), merkle.F.col("path"))).collect()
    assert {r.doc_id for r in proven} == {16, 44, 140} and {r.folded for r in proven} == {manifest.root}
