"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record is: payload length (8 bytes), masked CRC-32 of those 8 bytes (4), payload, masked CRC-32
of the payload (4), a line feed. The payload is the document id (8 bytes, signed), the width of an
id (1 byte: 2 or 4) and the ids; all numbers are little-endian. A checksum is masked by rotating
it right by 15 bits and adding a constant, so that checksums of data that holds checksums stay
sound. Texts are encoded where they lie; what is sorted by id and cut into files is the records.
Files are written by Spark's own writer, one record per row, so that a task that fails and runs
again leaves one copy, on any file system Spark writes to. File names sort in id order, and files
hold about ``file_bytes``, for each is read back as one value.

White space cuts a text into chunks, a word with the blanks before it, whose ids do not depend on
their neighbours (byte-level BPE splits before every run of blanks). Each worker keeps the ids of
``ROOM`` chunks it has met, in flat arrays of some 30 bytes a chunk, and hands the library only
others; what it keeps is found by two hashes of 64 bits.

Edge cases: null text is empty and gives the end id alone; a null id comes first and sets the high
bit of the width; repeated ids give a record each, in order of a hash of the text; an empty table
gives no record; other columns are not written.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendloom import session
from trendloom.functions.lookup import OpenTable
from trendloom.llm.base import query, table
from trendloom.llm.worker import drop, kept, slices

HEAD, CHECK, OWN = "<QI", "<I", "<qB"
HEAD_BYTES, OWN_BYTES = 12, 9
END_ID = 0
ROOM = 1_000_000  # chunks a worker keeps; then it starts anew
LONG = 64  # chunks with more bytes are not kept
NO_ID = 0x80
SAMPLED = 50  # keys a file, on average, to find where files begin

# White space beyond blank, tab and line breaks; texts that hold any are encoded in one go.
OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
LETTERS_SIGNS = re.compile("([ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]+)")
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 13, 32]] = True
POWERS = np.stack([np.cumprod(np.full(LONG, b)) for b in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))])


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record but for its line feed, which the writer adds."""
    size = len(payload).to_bytes(8, "little")
    return b"".join((size, struct.pack(CHECK, masked(size)), payload, struct.pack(CHECK, masked(payload))))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the record at ``at`` and where the next one starts; raises if damaged."""
    size, check = struct.unpack_from(HEAD, data, at)
    if masked(bytes(data[at : at + 8])) != check:
        raise ValueError(f"damaged length at byte {at}")
    start, end = at + HEAD_BYTES, at + HEAD_BYTES + size
    payload = data[start:end]
    if len(payload) != size or masked(payload) != struct.unpack_from(CHECK, data, end)[0] or data[end + 4] != 10:
        raise ValueError(f"damaged record at byte {at}")
    return payload, end + 5


class Encoder:
    """Ids of texts as bytes of ``width`` an id, through the ids of their chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would each keep memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]  # one id each, as the library gives it
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._forget()

    def _forget(self) -> None:
        self.table = OpenTable(ROOM)
        self.second = np.zeros(ROOM, np.uint64)  # of every chunk: another hash, and where its ids end
        self.ends = np.zeros(ROOM, np.int64)
        self.pool = np.zeros(4 * ROOM, f"<u{self.width}")
        self.size = 1  # chunk 0 has no ids

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, ids: list[list[int]], second: np.ndarray) -> np.ndarray:
        """Numbers of new chunks."""
        first, after = self.size, self.size + len(ids)
        begin = int(self.ends[first - 1])
        ends = begin + np.cumsum([len(x) for x in ids])
        flat = np.fromiter(chain.from_iterable(ids), self.pool.dtype, int(ends[-1]) - begin)
        for name, end in (("second", after), ("ends", after), ("pool", int(ends[-1]))):
            old = getattr(self, name)
            if end > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(end - len(old) + ROOM // 8, old.dtype)]))
        self.second[first:after], self.ends[first:after], self.pool[begin : ends[-1]] = second, ends, flat
        self.size = after
        return np.arange(first, after)

    def _chunks(self, data: np.ndarray, starts: np.ndarray, split: bool = True) -> np.ndarray:
        """The numbers of the chunks that begin at ``starts``; those not met before are learned."""
        lengths = np.diff(np.append(starts, len(data)))
        inside = np.minimum(np.arange(len(data)) - np.repeat(starts, lengths), LONG - 1)
        wide = data.astype(np.uint64) + np.uint64(1)
        key, second = (np.add.reduceat(wide * powers[inside], starts) for powers in POWERS)
        key = (key >> np.uint64(1)).astype(np.int64)
        out = self.table.find(key)
        out[(lengths > LONG) | (self.second[out] != second)] = -1
        fresh = np.flatnonzero(out < 0)
        if not len(fresh):
            return out
        short = fresh[lengths[fresh] <= LONG]
        _, first, which = np.unique(key[short], return_index=True, return_inverse=True)
        same = second[short] == second[short[first]][which]
        alone = np.concatenate([short[~same], fresh[lengths[fresh] > LONG]])
        asked = np.concatenate([short[first], alone])
        raw = data.tobytes()
        texts = [raw[a : a + n].decode() for a, n in zip(starts[asked].tolist(), lengths[asked].tolist(), strict=True)]
        numbers = self._add(self._learn(texts, split), second[asked])
        out[short[same]] = numbers[which[same]]
        out[alone] = numbers[len(first) :]
        new = self.table.find(key[short[first]]) < 0
        self.table.add(key[short[first]][new], numbers[: len(first)][new].astype(np.int32))
        return out

    def _learn(self, texts: list[str], split: bool) -> list[list[int]]:
        """Ids of chunks. Signs after a word have ids of their own, so the two are asked for apart."""
        parts = [m.groups() if split and (m := LETTERS_SIGNS.fullmatch(x)) else (x,) for x in texts]
        if not any(len(p) == 2 for p in parts):
            return self._ids(texts)
        both = list({y for p in parts if len(p) == 2 for y in p})
        coded = [y.encode() for y in both]
        numbers = self._chunks(np.frombuffer(b"".join(coded), np.uint8), np.cumsum([0, *map(len, coded[:-1])]), False).tolist()
        known = {y: self.pool[self.ends[n - 1] : self.ends[n]].tolist() for y, n in zip(both, numbers, strict=True)}
        whole = iter(self._ids([p[0] for p in parts if len(p) == 1]))
        return [known[p[0]] + known[p[1]] if len(p) == 2 else next(whole) for p in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.size > ROOM:
            self._forget()
        whole = [bool(OTHER_SPACE.search(t)) or any(a in t for a in self.added) for t in texts]
        apart = iter(self._ids([t for t, w in zip(texts, whole, strict=True) if w]))
        coded = [b"" if w else t.encode() for t, w in zip(texts, whole, strict=True)]
        data = np.frombuffer(b"".join(coded), np.uint8)
        borders = np.cumsum([0, *map(len, coded)])
        if len(data):
            blank = BLANK[data]
            begin = blank.copy()
            begin[1:] &= ~blank[:-1]
            begin[borders[:-1][np.diff(borders) > 0]] = True
            starts = np.flatnonzero(begin)
            numbers = self._chunks(data, starts)
            ends = self.ends[numbers]
            many = ends - self.ends[numbers - 1]
            after = np.cumsum(many)
            ids = self.pool[np.repeat(ends - after, many) + np.arange(int(after[-1]))]
            places = np.concatenate([[0], after])[np.searchsorted(starts, borders)].tolist()
        else:
            ids, places = self.pool[:0], [0] * len(borders)
        kind = self.pool.dtype
        return [
            np.array(next(apart), kind).tobytes() if w else ids[a:b].tobytes()
            for w, a, b in zip(whole, places[:-1], places[1:], strict=True)
        ]


def _encoded(path: str, bounds: np.ndarray):
    """(doc_id, hash, text) to (doc_id, hash, record, file): ``bounds`` are the first keys of files 1, 2 ..."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("records", path), lambda: Encoder(path))
        end = END_ID.to_bytes(encoder.width, "little")
        for batch in batches:
            for part in slices(batch, 2, 1000, 1 << 19):
                ids = part.column(0).to_pylist()
                keys = np.array([_key(i, h) for i, h in zip(ids, part.column(1).to_pylist(), strict=True)], bounds.dtype)
                files = pa.array(np.searchsorted(bounds, keys, "right"), pa.int32())
                heads = {True: encoder.width | NO_ID, False: encoder.width}
                texts = encoder.encode(part.column(2).to_pylist())
                frames = [frame(struct.pack(OWN, i or 0, heads[i is None]) + own + end) for i, own in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(frames, pa.binary()), files], ["doc_id", "hash", "record", "file"])

    return write


def _key(doc: int | None, hashed: int) -> bytes:
    """Sorts like (doc_id, hash), nulls first."""
    number = 0 if doc is None else doc + (1 << 63) + 1
    return number.to_bytes(9, "big") + (hashed + (1 << 63)).to_bytes(8, "big") + b"\1"


def write_records(docs: DataFrame, path: str, tokenizer: str, file_bytes: int = 24 << 20) -> None:
    """Write the ids of every text, in ascending order of doc_id, as record files under ``path``.

    A sample of the keys says where files begin, about ``SAMPLED`` keys a file, and decides nothing
    else; each text is read and encoded once, and only records are moved.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    rows, size = texts.agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    # Ids take at most about as many bytes as the text.
    files = max(-(-(size or 0) // file_bytes), min(cores, -(-(size or 0) // (4 << 20))), 1)
    every = max(1, rows // (SAMPLED * files))
    keys = texts.select("doc_id", "hash").filter(F.pmod(F.xxhash64(F.lit("file"), "doc_id", "hash"), F.lit(every)) == 0)
    found = sorted(_key(*r) for r in keys.collect()) if files > 1 else []
    bounds = np.array([found[len(found) * k // files] for k in range(1, files)] if found else [], "S18")
    encoded = texts.mapInArrow(_encoded(tokenizer, bounds), "doc_id long, hash long, record binary, file int")
    ordered = encoded.repartitionById(files, F.col("file")).sortWithinPartitions("doc_id", "hash")
    ordered.select(F.col("record").cast("string").alias("value")).write.text(path)


def _owner(payload: memoryview) -> tuple[int | None, int]:
    """The document id of a payload, null if it has none, and the width of its ids."""
    doc, width = struct.unpack_from(OWN, payload)
    return (None if width & NO_ID else doc), width & ~NO_ID


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "offset", "length", "doc_id", "n_tokens", "ids_crc32"]
    drop()  # what the encoding left in this worker
    for batch in batches:
        for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data, at, rows = memoryview(content.as_buffer()), 0, []
            while at < len(data):
                payload, after = unframe(data, at)
                doc, width = _owner(payload)
                ids = np.frombuffer(payload[OWN_BYTES :], f"<u{width}").astype("<u4")
                rows.append((file, at, after - at, doc, len(ids), zlib.crc32(ids.tobytes())))
                at = after
            if rows:
                types = (pa.string(), *[pa.int64()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, doc_id, n_tokens, ids_crc32, start), every record read and checked.

    ``start`` counts the ids of all records before. Only a row per file meets in one place.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    schema = "file string, offset long, length long, doc_id long, n_tokens long, ids_crc32 long"
    rows = session.run_dir(spark, "offsets")
    files.mapInArrow(_read, schema).write.parquet(rows)
    index = spark.read.schema(schema).parquet(rows)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("start", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(bases, "file").withColumn(
        "start", F.col("start") + F.col("base")
    ).drop("base")


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, places in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            data, docs, ids = memoryview(content.as_buffer()), [], []
            for place in places:
                payload, _ = unframe(data, place["offset"])
                doc, width = _owner(payload)
                docs.append(doc)
                ids.append(np.frombuffer(payload[OWN_BYTES :], f"<u{width}").astype("<i4"))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, seed: int = 0, files: int = 8) -> DataFrame:
    """(doc_id, ids) of the records an index names, in an order that ``seed`` decides."""
    places = index.groupBy("file").agg(F.collect_list(F.struct("offset")).alias("places"))
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    picked = whole.join(places, F.col("path") == F.col("file")).select("content", "places").mapInArrow(
        _pick, "doc_id long, ids array<int>"
    )
    return picked.repartitionByRange(files, F.xxhash64(F.lit(seed), "doc_id")).sortWithinPartitions(
        F.xxhash64(F.lit(seed), "doc_id"), "doc_id"
    )


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op6_token_records")
def token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token records; the digests come from the files read back."""
    path = session.run_dir(spark, "records")
    write_records(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return build_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
