"""A text classifier on learned vectors of hashed words, word pairs and character n-grams.

A text is the mean of the vectors of all its features: every word, every pair of neighbouring words
(words that repeat share one feature, whatever the word), and every run of 3 to 5 bytes within a word
and the blanks around it. A softmax over that mean gives the class. Vectors, softmax and all are
learned by stochastic gradient descent in numpy.

Training: at most ``max_labelled`` labelled texts (the first by hash of the id) are dealt by hash
over shards of about ``per_shard``. Each round every shard descends through its own texts, one after
another, from the same vectors, and the results are averaged; shards are streamed, so none is ever
held. What the driver sees is the vectors: ``2^bits`` times ``dims`` numbers a shard.

Scoring: a feature adds its vector's product with the softmax, one number per class, so a text needs
no vectors; the numbers are whole, in units of 2^-24, and their sums do not depend on how rows are
batched. Texts are read whole, in pieces that end between words.

Edge cases: null text is empty; an empty text has no feature and the score of the classes' shares;
labels that are null or no class are left out, of several labels of one id the least counts, of
several texts the least; without labels every class is as likely as the next; repeated rows score
alike; a word above ``PIECE`` bytes counts as several; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.base import free, query, store, table

LONGEST = 5
PIECE = 1 << 17
UNIT = float(1 << 24)
VECTOR_RATE, BIAS_RATE = 100.0, 0.1
BLANKS = bytes.maketrans(b"\x09\x0a\x0b\x0c\x0d", b" " * 5)
STEP, MIX, PAIR, REPEAT = (np.uint64(x) for x in (0x100000001B3, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def pieces(texts: Iterable[bytes | None]) -> Iterator[tuple[int, bytes]]:
    """(number of the text, piece): blanks made alike, cut between words, a blank around each."""
    for number, text in enumerate(texts):
        data = (text or b"").translate(BLANKS)
        at = 0
        while at < len(data):
            end = len(data)
            if end - at > PIECE:
                cut = data.rfind(b" ", at, at + PIECE)
                end = cut + 1 if cut > at else at + PIECE
            yield number, b" " + data[at:end] + b" "
            at = end


def blocks(texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Pieces of neighbouring texts, together about ``PIECE`` bytes: their numbers and contents."""
    numbers: list[int] = []
    parts: list[bytes] = []
    size = 0
    for number, part in pieces(texts):
        numbers.append(number)
        parts.append(part)
        size += len(part)
        if size >= PIECE:
            yield np.array(numbers), parts
            numbers, parts, size = [], [], 0
    if parts:
        yield np.array(numbers), parts


class Reader:
    """Turns blocks into feature numbers below ``2^bits``; ``2^bits`` itself stands for none."""

    def __init__(self, bits: int):
        self.none = 1 << bits
        self.shift = np.uint64(64 - bits)
        size = 2 * PIECE + 4
        self.powers = np.cumprod(np.full(size, STEP))
        self.inverse = np.cumprod(np.full(size, np.uint64(pow(int(STEP), -1, 1 << 64))))
        self.last: tuple[int, np.uint64] = (-1, REPEAT)  # the word before this block, and whose it is

    def _bucket(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        mixed = (hashes + np.uint64(kind)) * MIX
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * MIX) >> self.shift).astype(np.int64)

    def families(self, numbers: np.ndarray, parts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(features, borders): the features of piece ``i`` are those from border ``i`` to ``i + 1``."""
        buf = np.frombuffer(b"".join(parts), np.uint8)
        solid, wide = buf != 32, buf.astype(np.uint64)
        size = len(buf)
        borders = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        runs, inner = wide, solid[1:]
        for n in range(2, LONGEST + 1):
            m = max(size - n + 1, 0)
            runs = runs[:m] * STEP + wide[n - 1 :]
            if n > 2:
                inner = inner[:m] if n == 3 else inner[:m] & solid[n - 2 : n - 2 + m]
                features = np.full(size, self.none)
                features[:m] = np.where(inner, self._bucket(runs, n), self.none)
                yield features, borders
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        first, after = edges[::2] + 1, edges[1::2] + 1
        sums = np.cumsum((wide + np.uint64(1)) * self.powers[:size])
        words = (sums[after - 1] - sums[first - 1]) * self.inverse[first]
        at = np.searchsorted(first, borders)
        yield self._bucket(words, 1), at
        if len(words):
            owner = numbers[np.searchsorted(borders, first, "right") - 1]
            before = np.concatenate([[self.last[1]], words[:-1]])
            joined = np.concatenate([[self.last[0] == owner[0]], owner[1:] == owner[:-1]])
            pairs = np.where(before == words, REPEAT, before * PAIR + words)
            yield np.where(joined, self._bucket(pairs, 2), self.none), at
            self.last = (int(owner[-1]), words[-1])


def features_of(texts: Sequence[bytes | None], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: its distinct features, and how often it has each."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    reader = Reader(bits)
    for numbers, parts in blocks(texts):
        for features, borders in reader.families(numbers, parts):
            for i, number in enumerate(numbers.tolist()):
                found[number].append(features[borders[i] : borders[i + 1]])
    out = []
    for own in found:
        ids, n = np.unique(np.concatenate(own) if own else np.zeros(0, np.int64), return_counts=True)
        keep = ids < (1 << bits)
        out.append((ids[keep], n[keep]))
    return out


@dataclass(frozen=True)
class Model:
    """``vectors``: 2^bits x dims, ``weights``: dims x classes, ``bias``: per class."""

    classes: tuple
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def gains(self) -> np.ndarray:
        """Per class and feature, in whole units, what the feature adds; the last column adds nothing."""
        whole = np.rint(self.vectors.astype(np.float64) @ self.weights * UNIT).astype(np.int64)
        return np.concatenate([whole, np.zeros((1, len(self.classes)), np.int64)]).T.copy()


def start(classes: tuple, counts: Sequence[int], bits: int, dims: int) -> Model:
    rng = np.random.default_rng(12)
    vectors = rng.uniform(-1 / dims, 1 / dims, (1 << bits, dims))
    share = (np.array(counts, np.float64) + 1) / (sum(counts) + len(classes))
    return Model(classes, vectors.astype(np.float32), np.zeros((dims, len(classes))), np.log(share))


def descend(model: Model, cases: Iterable[tuple[np.ndarray, np.ndarray, int]], rate: float) -> Model:
    """The model after one pass over (features, counts, class).

    A text moves its features' vectors in proportion to their counts, ``VECTOR_RATE`` times as fast
    as the softmax, for each has only its share in the mean; the bias, where it starts right, slower.
    """
    vectors, weights, bias = model.vectors.copy(), model.weights.copy(), model.bias.copy()
    for ids, n, own in cases:
        share = (n / max(n.sum(), 1)).astype(np.float64)
        mean = share @ vectors[ids]
        z = mean @ weights + bias
        miss = np.exp(z - z.max())
        miss /= miss.sum()
        miss[own] -= 1
        back = weights @ miss
        weights -= rate * np.outer(mean, miss)
        bias -= BIAS_RATE * rate * miss
        if len(ids):
            vectors[ids] -= (rate * VECTOR_RATE * np.outer(share, back)).astype(np.float32)
    return Model(model.classes, vectors, weights, bias)


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, classes: Sequence, max_labelled: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(order, own, text): at most ``max_labelled`` texts with the place of their class."""
    own = F.array_position(F.array(*map(F.lit, classes)), F.col(label)) - 1
    sample = (
        labels.filter(F.col(label).isin(list(classes)))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(own).cast("int").alias("own"))
        .filter(F.col("_key").isNotNull())
        .withColumn("order", F.xxhash64("_key"))
        .orderBy("order", "_key")
        .limit(max_labelled)
    )
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).cast("binary").alias("text"))
    one = texts.join(F.broadcast(sample), "_key").groupBy("_key", "order", "own").agg(F.min("text").alias("text"))
    return one.drop("_key")


def _shard_passes(model: Model, bits: int, rate: float):
    """Descend through every shard of a task's rows, which are sorted by shard; a row per shard."""

    def cases(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for part in parts:
            for at in range(0, part.num_rows, 64):
                some = part.slice(at, 64)
                for (ids, n), own in zip(features_of(some.column(2).to_pylist(), bits), some.column(1).to_pylist(), strict=True):
                    yield ids, n, own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, now = -1, model
        for batch in batches:
            shards = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for start_at, end in zip(cuts, cuts[1:], strict=False):
                if end == start_at:
                    continue
                if shards[start_at] != present:
                    if present >= 0:
                        yield _packed(present, now)
                    present, now = int(shards[start_at]), model
                now = descend(now, cases(iter([batch.slice(start_at, end - start_at)])), rate)
        if present >= 0:
            yield _packed(present, now)

    return run


def _packed(shard: int, model: Model) -> pa.RecordBatch:
    columns = [[shard], [model.vectors.tobytes()], [model.weights.tobytes()], [model.bias.tobytes()]]
    types = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["shard", "vectors", "weights", "bias"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    classes: Sequence = (0, 1),
    max_labelled: int = 20_000,
    bits: int = 16,
    dims: int = 8,
    per_shard: int = 2_500,
    rounds: int = 5,
    rate: float = 1.0,
) -> Model:
    """A model of the labelled texts of ``docs``; rows not to learn from are to be left out before."""
    sample = store(labelled(docs, labels, label, classes, max_labelled), "labelled")
    found = {r["own"]: r["n"] for r in sample.groupBy("own").agg(F.count("*").alias("n")).collect()}
    model = start(tuple(classes), [found.get(i, 0) for i in range(len(classes))], bits, dims)
    shards = max(1, sum(found.values()) // per_shard)
    shard = F.pmod(F.xxhash64(F.lit("shard"), "order"), F.lit(shards)).cast("int")
    dealt = sample.withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard", "order", F.xxhash64("text")).select("shard", "own", "text")
    schema = "shard int, vectors binary, weights binary, bias binary"
    for k in range(rounds):
        got = dealt.mapInArrow(_shard_passes(model, bits, rate * (1 - k / rounds)), schema).collect()  # a row per shard
        if not got:
            break
        mean = lambda name, like: np.mean([np.frombuffer(r[name], like.dtype).reshape(like.shape) for r in sorted(got)], axis=0, dtype=np.float64).astype(like.dtype)
        model = Model(model.classes, mean("vectors", model.vectors), mean("weights", model.weights), mean("bias", model.bias))
    return model


def _scorer(gains: np.ndarray, bias: np.ndarray, bits: int, place: int):
    """Gains are taken less those of ``place``, whose probability is the score."""
    others = [i for i in range(len(bias)) if i != place]
    tables = [gains[i] - gains[place] for i in others]
    lead = bias[others] - bias[place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                sums, n = np.zeros((len(tables), some.num_rows), np.int64), np.zeros(some.num_rows, np.int64)
                reader = Reader(bits)
                for numbers, parts in blocks(some.column(0).to_pylist()):
                    for features, borders in reader.families(numbers, parts):
                        ends = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[borders])  # noqa: B023, E731
                        np.add.at(n, numbers, ends(features != reader.none))
                        for total, gain in zip(sums, tables, strict=True):
                            np.add.at(total, numbers, ends(gain[features]))
                z = sums / (np.maximum(n, 1) * UNIT) + lead[:, None]
                score = 1 / (1 + np.exp(np.minimum(z, 700)).sum(axis=0))
                yield pa.RecordBatch.from_arrays([*some.columns[1:], pa.array(score)], [*some.schema.names[1:], "score"])

    return run


def scores(docs: DataFrame, model: Model, of, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` (none named ``score``) of every row, and ``score``: the probability of class ``of``."""
    bits = len(model.vectors).bit_length() - 1
    rows = docs.select(F.col(text).cast("binary").alias(free("_text", keep)), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(_scorer(model.gains(), model.bias, bits, model.classes.index(of)), schema + ", score double")


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


@query("op12_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by a model of labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    return scores(docs, model, 1).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )
