"""Scoring texts with a hashed maximum-entropy language model.

P(word | history) = P(class | history) * P(word | class, previous class). Both factors are
log-linear. The class softmax has hashed features of the previous word, the two previous words
and, skipping one, the word before the previous; the word softmax has hashed features of the
previous class and the word, on top of the word's share of its class. Words are ranked by count
and cut into classes of equal sums of square-rooted counts; the end of a text is a class, and so
are together all words beyond the ``head`` most frequent, among which the share of a word is its
smoothed count. The probabilities of all words, one unknown word and the end add up to one.

Training: the learning texts are dealt over ``rounds`` by hash, so that all take part. Each round
every task adds up the seen and the expected features of its texts under the present weights; the
sums (of a size that parameters fix) are added by blocks and the weights move along the gradient,
seen minus expected, divided by the mean of both. Word counts are a grouped sum over all texts.

The head is broadcast: at most ``head`` words of at most 64 bytes. Counts of all other words are
joined by word, so the base score is exact for a vocabulary of any size.

Edge cases: null text is empty and is its end alone; without learning texts every class and word
is as likely as the next; repeated rows are scored and counted each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.base import query, store, table

TAIL, END, START, FIRST = 0, 1, 2, 3
LONGEST = 64
FLUSH = 300_000
STEP = 32_768
BINS = (1 << 13, 1 << 14, 1 << 13)
WORD_BINS = 1 << 18
KAPPA = 4.0
BLOCK = 1 << 14
TEN = log(10)


def words_of(text: bytes | None) -> list[bytes]:
    """Bytes keep lower-casing to A-Z and splitting to the six ASCII spaces."""
    return text.lower().split() if text else []


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Model:
    """Word ids: TAIL, END, START, then the head by falling count. START is only ever history."""

    words: list[bytes]
    counts: np.ndarray  # of TAIL, END, START (0) and the head
    classes: np.ndarray  # the class of each id; class 0 is TAIL, class 1 END
    bias: np.ndarray
    weights: np.ndarray  # feature bins x classes
    word_weights: np.ndarray

    def prepare(self) -> None:
        """The tables that a worker needs: bins by id, and word scores by previous class."""
        ids = np.arange(len(self.classes), dtype=np.uint64)
        self.bin1 = (_mix(ids, 1) % np.uint64(BINS[0])).astype(np.int32)
        self.bin3 = (_mix(ids, 3) % np.uint64(BINS[2])).astype(np.int32) + BINS[0] + BINS[1]
        self.key2 = _mix(ids, 2)
        n = len(self.bias)
        self.word_bins = np.empty((n, len(ids)), np.int32)
        self.word_logp = np.empty((n, len(ids)), np.float32)
        for before, (bins, logp) in enumerate(self.word_rows()):
            self.word_bins[before], self.word_logp[before] = bins, logp

    def word_rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For every previous class: the bins of all words, and their log share of their class."""
        n = len(self.bias)
        share = np.maximum(self.counts, 0.5)
        share[START] = 1e-30
        total = np.bincount(self.classes, share, n)
        base = np.log(share / total[self.classes]).astype(np.float32)
        ids = np.arange(len(self.classes), dtype=np.uint64)
        for before in range(n):
            bins = (_mix(ids + np.uint64(before << 32), 5) % np.uint64(WORD_BINS)).astype(np.int32)
            score = base + self.word_weights[bins]
            score[[TAIL, END]] = 0
            z = np.log(np.maximum(np.bincount(self.classes, np.exp(score), n), 1e-300))  # classes may be empty
            yield bins, score - z[self.classes].astype(np.float32)

    def plain(self) -> tuple:
        """What a broadcast carries: no class of this package, which executors may lack."""
        return self.words, self.counts, self.classes, self.bias, self.weights, self.word_weights

    def features(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature bins (3 x tokens) and the previous word of each token."""
        one, two = np.empty_like(ids), np.empty_like(ids)
        one[1:], two[2:] = ids[:-1], ids[:-2]
        one[starts] = START
        two[starts] = START
        second = starts + 1
        two[second[second < len(ids)]] = START
        two[starts] = START
        pair = (self.key2[one] * np.uint64(3) + self.key2[two]) >> np.uint64(20)
        bin2 = (pair % np.uint64(BINS[1])).astype(np.int32) + BINS[0]
        return np.stack([self.bin1[one], bin2, self.bin3[two]]), one

    def class_logp(self, bins: np.ndarray) -> np.ndarray:
        scores = self.weights[bins[0]]
        scores += self.weights[bins[1]]
        scores += self.weights[bins[2]]
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return scores


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        return TAIL


def _numbered(batch: pa.RecordBatch, column: int, ids: _Ids) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, int]]:
    """Some texts at a time: their words and ends as one list, ids, starts, and the first row."""
    texts = batch.column(column)
    words: list[bytes] = []
    starts: list[int] = []
    first = 0
    for i in range(len(texts)):
        starts.append(len(words))
        words += words_of(texts[i].as_py())
        words.append(b"")
        if len(words) > 1 << 18 or i == len(texts) - 1:
            numbers = np.fromiter(map(ids.__getitem__, words), np.int32, len(words))
            yield words, numbers, np.array(starts), first
            words, starts, first = [], [], i + 1


def _ids(model: Model) -> _Ids:
    ids = _Ids({w: i + FIRST for i, w in enumerate(model.words)})
    ids[b""] = END
    return ids


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for text in batch.column(0):
            counts.update(words_of(text.as_py()))
            if len(counts) > FLUSH:
                yield rows()
                counts.clear()
        counts[b""] += batch.num_rows
    if counts:
        yield rows()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts, the empty word being the end; summed in the task first."""
    return texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def start_model(counts: DataFrame, head: int, n_classes: int) -> tuple[Model, int, int]:
    """The model before training, the number of tokens and of distinct tokens."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    fits = counts.filter((F.length("word") > 0) & (F.length("word") <= LONGEST))
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = fits.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # 1,024 rows at most
    least, room = None, head
    for row in levels:
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    kept = fits.filter(level >= (least if least is not None else 1 << 20)).select("word", "n").toArrow()  # head rows at most
    top = sorted(zip(kept.column("word").to_pylist(), kept.column("n").to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
    ends = counts.filter(F.length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = np.array([n for _, n in top], np.float64)
    numbers = np.concatenate([[total[0] - ends - own.sum(), ends, 0], own])
    mass = np.cumsum(np.sqrt(own)) if len(own) else np.zeros(0)
    classes = np.zeros(len(numbers), np.int64)
    classes[END] = 1
    if len(own):
        classes[FIRST:] = 2 + np.minimum(n_classes - 3, (mass / mass[-1] * (n_classes - 2)).astype(int))
    classes[START] = n_classes - 1
    by_class = np.bincount(classes, numbers, n_classes) + 1
    bias = np.log(by_class / by_class.sum()).astype(np.float32)
    model = Model(
        [w for w, _ in top], numbers, classes, bias,
        np.zeros((sum(BINS), n_classes), np.float32), np.zeros(WORD_BINS, np.float32),
    )
    return model, int(total[0]), int(total[1])


def _gradient(shared: Broadcast):
    def gradient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        model.prepare()
        ids = _ids(model)
        n = len(model.bias)
        seen, expected = np.zeros(model.weights.shape), np.zeros(model.weights.shape, order="F")
        words, pairs = np.zeros(WORD_BINS), np.zeros((n, n))
        offsets = (0, BINS[0], BINS[0] + BINS[1])
        for batch in batches:
            for _, numbers, starts, _ in _numbered(batch, 0, ids):
                bins, before = model.features(numbers, starts)
                own, past = model.classes[numbers], model.classes[before]
                words += np.bincount(model.word_bins[past, numbers], minlength=WORD_BINS)
                pairs += np.bincount(past * n + own, minlength=n * n).reshape(n, n)
                for f in range(3):
                    seen += np.bincount(bins[f] * n + own, minlength=seen.size).reshape(seen.shape)
                for at in range(0, len(numbers), STEP):
                    part = bins[:, at : at + STEP]
                    share = np.ascontiguousarray(np.exp(model.class_logp(part)).T, np.float64)
                    for f in range(3):
                        row = part[f] - offsets[f]
                        for c in range(n):
                            expected[offsets[f] : offsets[f] + BINS[f], c] += np.bincount(row, share[c], BINS[f])
        out = np.concatenate([seen.ravel(), expected.ravel(), words, pairs.ravel()])
        blocks = range(0, len(out), BLOCK)
        parts = [out[at : at + BLOCK].tobytes() for at in blocks]
        yield pa.RecordBatch.from_arrays([pa.array([at // BLOCK for at in blocks], pa.int32()), pa.array(parts, pa.binary())], ["block", "sums"])

    return gradient


def _add_up(parts: pa.Table) -> pa.Table:
    """The sums of one block, a row per task before; added in an order that does not depend on tasks."""
    rows = sorted(parts.column("sums").to_pylist())
    total = np.sum([np.frombuffer(r, np.float64) for r in rows], axis=0)
    return pa.table([pa.array([parts.column("block")[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "sums"])


def train(
    texts: DataFrame,
    counts: DataFrame,
    key: Column,
    head: int = 1 << 17,
    n_classes: int = 32,
    rounds: int = 3,
    rate: float = 0.6,
) -> tuple[Model, int, int]:
    """The trained model, the number of tokens and of distinct tokens it learned from.

    ``texts`` has the column ``text`` as binary; ``key`` deals its rows over the rounds.
    """
    spark = texts.sparkSession
    model, n_tokens, n_distinct = start_model(counts, head, n_classes)
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(model.plain())
        own = texts.filter(F.pmod(F.xxhash64(key), F.lit(rounds)) == k).select("text")
        # Sums meet by block of BLOCK numbers; what the driver gets is one set of them.
        tasks = own.coalesce(max(1, 2 * spark.sparkContext.defaultParallelism))
        parts = tasks.mapInArrow(_gradient(shared), "block int, sums binary")
        whole = parts.groupBy("block").applyInArrow(_add_up, "block int, sums binary").toArrow()
        sums = np.zeros(2 * model.weights.size + WORD_BINS + n_classes * n_classes)
        for block, values in zip(whole.column(0).to_pylist(), whole.column(1), strict=True):
            found = np.frombuffer(values.as_buffer(), np.float64)
            sums[block * BLOCK : block * BLOCK + len(found)] = found
        size = model.weights.size
        seen, expected = sums[:size].reshape(model.weights.shape), sums[size : 2 * size].reshape(model.weights.shape)
        words, pairs = sums[2 * size : 2 * size + WORD_BINS], sums[2 * size + WORD_BINS :].reshape(n_classes, n_classes)
        hoped = np.zeros(WORD_BINS)
        for before, (bins, logp) in enumerate(model.word_rows()):
            hoped += np.bincount(bins, np.exp(logp) * pairs[before][model.classes], WORD_BINS)
        model = Model(
            model.words, model.counts, model.classes, model.bias,
            (model.weights + rate * (seen - expected) / ((seen + expected) / 2 + KAPPA)).astype(np.float32),
            (model.word_weights + (words - hoped) / ((words + hoped) / 2 + KAPPA)).astype(np.float32),
        )
        shared.unpersist()
    return model, n_tokens, n_distinct


SCORED = "row long, word binary, n long, known long, base double, score double"


def _scorer(shared: Broadcast, norm: float):
    """A row per text (word null), and a row per text and word of it beyond the head."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        model.prepare()
        ids = _ids(model)
        schema = pa.schema([("row", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
        base = (np.log(model.counts + 1) - np.log(norm)) / TEN
        known = (model.counts > 0).astype(np.int64)
        base[TAIL], known[TAIL] = 0, 0
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for words, numbers, starts, first in _numbered(batch, 1, ids):
                bins, before = model.features(numbers, starts)
                own = model.classes[numbers]
                logp = model.word_logp[model.classes[before], numbers].astype(np.float64)
                for at in range(0, len(numbers), STEP):
                    part = model.class_logp(bins[:, at : at + STEP])
                    logp[at : at + STEP] += part[np.arange(len(part)), own[at : at + STEP]]
                mine = rows[first : first + len(starts)]
                total = lambda x: np.add.reduceat(x, starts)
                n = np.diff(np.append(starts, len(numbers)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine), pa.nulls(len(mine), pa.binary()), pa.array(n), pa.array(total(known[numbers])), pa.array(total(base[numbers])), pa.array(total(logp) / TEN)],
                    schema=schema,
                )
                rare = np.flatnonzero(numbers == TAIL)
                if len(rare):
                    doc = mine[np.searchsorted(starts, rare, "right") - 1]
                    each = Counter(zip(doc.tolist(), map(words.__getitem__, rare.tolist()), strict=True))
                    r, w = zip(*each, strict=True)
                    none = pa.nulls(len(r), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r, pa.int64()), pa.array(w, pa.binary()), pa.array(each.values(), pa.int64()), none, none.cast(pa.float64()), none.cast(pa.float64())],
                        schema=schema,
                    )

    return score


def score(docs: DataFrame, learn_from: Column, **parameters) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    ``learn_from`` says which rows the model learns from; ``parameters`` go to ``train``.
    """
    spark = docs.sparkSession
    raw = docs.withColumn("text", F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    texts = raw.filter(learn_from)
    counts = store(word_counts(texts.select("text")), "counts")
    model, n_tokens, n_distinct = train(texts, counts, F.col("doc_id"), **parameters)
    norm = n_tokens + n_distinct + 1
    tail = int(model.counts[TAIL])
    tail_norm = tail + (n_distinct - len(model.words) - (1 if model.counts[END] else 0)) + 1
    shared = spark.sparkContext.broadcast(model.plain())
    numbered = raw.withColumn("row", F.monotonically_increasing_id())
    out = numbered.select("row", "text", "doc_id").mapInArrow(_with_id(_scorer(shared, norm)), "doc_id long, " + SCORED)
    out = store(out, "scored")
    c = F.coalesce(F.col("c"), F.lit(0))
    rare = (
        out.filter(F.col("word").isNotNull())
        .join(counts.withColumnRenamed("n", "c"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"),
            F.sum(F.col("n") * (F.log10(c + 1) - F.log10(F.lit(float(norm))))).alias("rare_base"),
            F.sum(F.col("n") * (F.log10(c + 1) - F.log10(F.lit(float(tail_norm))))).alias("rare_score"),
        )
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    return (
        out.filter(F.col("word").isNull())
        .join(rare, "row", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_tokens"),
            (F.col("known") + zero("more")).alias("n_known"),
            F.lit(n_tokens).cast("long").alias("train_tokens"),
            (F.col("base") + zero("rare_base")).alias("base_score"),
            (F.col("score") + zero("rare_score")).alias("score"),
        )
    )


def _with_id(scorer):
    """Put the id of each text's row before it; words beyond the head need none."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = batch.column(0).to_numpy(), batch.column(2)
            for out in scorer(iter([batch])):
                at = np.searchsorted(rows, out.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *out.columns], ["doc_id", *out.schema.names])

    return score


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 7 == 2


@query("op1_maxent_score")
def maxent_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score(docs, ~held_out(F.col("doc_id")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
