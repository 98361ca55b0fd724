"""Benchmark decontamination: find benchmark items inside texts, up to an edit budget.

Texts and items are compared as UTF-8 bytes with A-Z in lower case and any of the six ASCII
spaces as a blank. An item of m bytes may differ from a passage by k = min(rate * m, (m - q) / q)
edits. By the q-gram lemma the two then share at least m - q + 1 - q * k q-grams, on diagonals
(place in the text minus place in the item) that spread over k at most. Bands of 2k + 1 diagonals
start every k + 1, so one of them holds them all; only bands that reach the bound are aligned, by
an edit distance that stays inside the band and may start and end anywhere in the text.

The benchmark is handed out in blocks of at most ``block_bytes``, each read against all rows.

Edge cases: null text and null items are empty; items shorter than q bytes are left out, as any
text would match them; repeated items count by id, repeated texts by row; empty tables give an
empty result; other columns stay out of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm.base import free, query, table
from trendloom.llm.byteops import buffers, gram_hashes

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[9:14] = 32
MATCHES = "doc_id long, item_id long, start long, end long, edits int"
FILTER_BITS = 22


def budget(m: int, rate: float, q: int) -> int:
    return max(0, min(int(rate * m), (m - q) // q))


class Index:
    """The q-grams of a block of items: sorted hashes with their places, and a bit table."""

    def __init__(self, items: list[tuple[int, bytes]], q: int, rate: float):
        self.q, self.rate = q, rate
        self.items = [(i, FOLD[np.frombuffer(b, np.uint8)]) for i, b in items]
        parts = [gram_hashes(b, q) for _, b in self.items]
        sizes = [len(p) for p in parts]
        hashes = np.concatenate([*parts, np.zeros(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.place = np.concatenate([*[np.arange(n) for n in sizes], np.zeros(0, int)])[order]
        self.lengths = np.array([len(b) for _, b in self.items] or [0])
        self.budgets = np.array([budget(n, rate, q) for n in self.lengths.tolist()])
        self.least = self.lengths - q + 1 - q * self.budgets
        self.bits = np.zeros(1 << FILTER_BITS, bool)
        self.bits[hashes >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in the text, items and places in the items of the q-grams they share."""
        hashes = gram_hashes(text, self.q)
        at = np.flatnonzero(self.bits[hashes >> np.uint64(64 - FILTER_BITS)])
        first = np.searchsorted(self.hashes, hashes[at], "left")
        many = np.searchsorted(self.hashes, hashes[at], "right") - first
        place = np.repeat(at, many)
        entry = np.repeat(first - np.cumsum(many) + many, many) + np.arange(len(place))
        return place, self.item[entry], self.place[entry]


def align(jobs: list[tuple[np.ndarray, np.ndarray, int, int]]) -> list[tuple[int, int, int]]:
    """(edits, start, end) of the best passage for each (text, item, low, high), its alignment
    staying on diagonals low..high.

    Cell j of row i stands for place low + i + j of the text. A second array carries where the
    best alignment of each cell starts. All jobs advance together, the longest items first, so
    those that end leave the rear of the arrays.
    """
    order = sorted(range(len(jobs)), key=lambda j: -len(jobs[j][1]))
    sizes = np.array([len(jobs[j][1]) for j in order])
    widths = np.array([jobs[j][3] - jobs[j][2] + 1 for j in order])
    lows = np.array([jobs[j][2] for j in order])
    ends = np.array([len(jobs[j][0]) for j in order])
    most, width = int(sizes[0]), int(widths.max())
    items = np.zeros((len(jobs), most), np.int16)
    window = np.full((len(jobs), most + width), -1, np.int16)  # the texts from place low on
    for r, j in enumerate(order):
        text, item, low, _ = jobs[j]
        items[r, : len(item)] = item
        part = text[max(low, 0) : max(low + most + width, 0)]
        window[r, max(-low, 0) : max(-low, 0) + len(part)] = part
    far = most + width + 1
    steps = np.arange(width)
    outside = lambda i, n: (steps < (-lows[:n] - i)[:, None]) | (steps >= np.minimum(widths[:n], ends[:n] - lows[:n] - i + 1)[:, None])
    cost, start = np.where(outside(0, len(jobs)), far, 0), lows[:, None] + steps
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(jobs)
    left = len(jobs)
    for i in range(most + 1):
        if i:
            swap = cost + (window[:left, i - 1 : i - 1 + width] != items[:left, i - 1 : i])
            best, origin = swap.copy(), start.copy()
            skip = cost[:, 1:] + 1
            fewer = skip < swap[:, :-1]
            np.copyto(best[:, :-1], skip, where=fewer)
            np.copyto(origin[:, :-1], start[:, 1:], where=fewer)
            off = outside(i, left)
            best[off] = far
            best -= steps
            run = np.minimum.accumulate(best, axis=1)
            source = np.maximum.accumulate(np.where(best == run, steps, 0), axis=1)
            cost, start = run + steps, np.take_along_axis(origin, source, 1)
            cost[off] = far
        done = int(np.searchsorted(-sizes[:left], -i, "left"))
        for r in range(done, left):
            at = int(np.argmin(cost[r]))
            out[order[r]] = (int(cost[r, at]), int(start[r, at]), int(lows[r]) + i + at)
        cost, start, left = cost[:done], start[:done], done
        if not left:
            break
    return out


def candidates(text: np.ndarray, index: Index) -> list[tuple[int, int]]:
    """(item number, lowest diagonal) of the bands that share enough q-grams with an item."""
    place, item, own = index.hits(text)
    if not len(place):
        return []
    counts = np.bincount(item, minlength=len(index.items))
    keep = counts[item] >= index.least[item]
    place, item, own = place[keep], item[keep], own[keep]
    if not len(place):
        return []
    step = index.budgets[item] + 1
    diagonal = place - own + index.lengths[item]
    band = diagonal // step
    item2 = np.concatenate([item, item])
    band2 = np.concatenate([band, band - 1])  # a band takes in the first half of the next
    own2 = np.concatenate([own, own])
    # An item's gram counts once a band, wherever the text repeats it.
    triples = np.unique(np.stack([item2, band2, own2]), axis=1)
    groups, n = np.unique(triples[:2], axis=1, return_counts=True)
    enough = groups[:, n >= index.least[groups[0]]]
    return list(zip(enough[0].tolist(), (enough[1] * (index.budgets[enough[0]] + 1) - index.lengths[enough[0]]).tolist(), strict=True))


Found = list[tuple[int, int, int, int]]


def _verified(waiting: list[tuple[int, int, np.ndarray, list[tuple[int, int]]]], index: Index) -> dict[int, set]:
    """{owner: (item number, edits, start, end)} of the bands of some pieces, aligned together.
    Of passages of one item that overlap in a piece, the one with the fewest edits stands."""
    jobs = [(text, index.items[i][1], low, low + 2 * int(index.budgets[i]) + 1) for _, _, text, found in waiting for i, low in found]
    aligned = iter(align(jobs) if jobs else ())
    out: dict[int, set] = {}
    for owner, base, _, found in waiting:
        edits_of: dict[tuple[int, int, int], int] = {}
        for i, _ in found:
            edits, start, end = next(aligned)
            if edits <= index.budgets[i]:
                key = (i, start + base, end + base)
                edits_of[key] = min(edits, edits_of.get(key, edits))
        best: Found = []
        for (i, start, end), edits in sorted(edits_of.items(), key=lambda x: (x[0][0], x[1], x[0][1], x[0][2])):
            if not any(i == j and start < e and s < end for j, _, s, e in best):
                best.append((i, edits, start, end))
        out.setdefault(owner, set()).update(best)
    return out


def find(text: np.ndarray, index: Index) -> Found:
    """(item number, edits, start, end) for each passage of one text."""
    return sorted(_verified([(0, 0, text, candidates(text, index))], index)[0])


def passages(column: pa.Array, index: Index, piece: int, cells: int = 1 << 18) -> list[Found]:
    """The passages in each text of a column. Long texts go in pieces that overlap by more than
    any passage; bands are aligned together, as many as ``cells`` cells of a row and item allow."""
    data, ends = buffers(column)
    reach = int((index.lengths + 2 * index.budgets + 2).max())
    found: list[set] = [set() for _ in range(len(column))]
    waiting, size = [], 0

    def settle() -> None:
        for owner, more in _verified(waiting, index).items():
            found[owner] |= more
        waiting.clear()

    for owner, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        for at in range(a, max(b, a + 1), piece):
            text = FOLD[data[at : min(at + piece + reach, b)]]
            bands = candidates(text, index)
            if bands:
                waiting.append((owner, at - a, text, bands))
                size += len(bands) * reach
                if size > cells:
                    settle()
                    size = 0
    settle()
    return [sorted(x) for x in found]


def _scanner(items: list[tuple[int, bytes]], q: int, rate: float, piece: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, q, rate)
        schema = pa.schema([(x, pa.int64()) for x in ("doc_id", "item_id", "start", "end")] + [("edits", pa.int32())])
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = passages(batch.column(1), index, piece)
            rows = [(doc, index.items[i][0], s, e, n) for doc, own in zip(ids, found, strict=True) for i, n, s, e in own]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return scan


def _marker(items: list[tuple[int, bytes]], q: int, rate: float, piece: int, names: list[str]):
    """Pass rows on, last a flag: true if it was or if the text holds an item of this block."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, q, rate)
        for batch in batches:
            found = passages(batch.column(0), index, piece)
            leaks = [before or bool(own) for before, own in zip(batch.column(1).to_pylist(), found, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(leaks, pa.bool_())], names)

    return mark


def blocks(benchmark: DataFrame, q: int, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of bounded size, one block at a time on the driver."""
    rows = benchmark.filter(F.length(F.encode("text", "UTF-8")) >= q).select("item_id", F.encode("text", "UTF-8").alias("text"))
    block, size = [], 0
    for row in rows.distinct().sort("item_id", "text").toLocalIterator():
        if block and size + len(row.text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row.item_id, bytes(row.text)))
        size += len(row.text)
    if block:
        yield block


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = 0.08,
    q: int = 10,
    block_bytes: int = 4 << 20,
    piece: int = 1 << 20,
) -> DataFrame:
    """(doc_id, item_id, start, end, edits): passages of items in texts, in bytes of the text."""
    texts = docs.select(F.col("doc_id").cast("long"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    out = docs.sparkSession.createDataFrame([], MATCHES)
    for block in blocks(benchmark, q, block_bytes):
        out = out.unionByName(texts.mapInArrow(_scanner(block, q, rate, piece), MATCHES))
    return out.dropDuplicates(["doc_id", "item_id", "start", "end"])


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = 0.08,
    q: int = 10,
    block_bytes: int = 4 << 20,
    piece: int = 1 << 20,
) -> DataFrame:
    """The rows of ``docs`` whose text holds no passage of an item; rows need no id for it."""
    names = docs.columns
    leak, before, raw = (free(name, names) for name in ("_leak", "_before", "_bytes"))
    schema = T.StructType([*docs.schema.fields, T.StructField(leak, T.BooleanType())])  # add() would change docs.schema
    out = docs.withColumn(leak, F.lit(False))
    for block in blocks(benchmark, q, block_bytes):
        text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
        given = out.select(text.alias(raw), F.col(leak).alias(before), *names)
        out = given.mapInArrow(_marker(block, q, rate, piece, schema.names), schema)
    return out.filter(~F.col(leak)).select(*names)


@query("op10_decontaminate")
def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a benchmark item in any document, within the edit budget."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
