"""SentencePiece encoding with seeded merge dropout, and its decoding without loss.

Encoding is the BPE of the model: the adjacent pair whose union has the best score merges first,
the leftmost of equals. With dropout, a hash of (seed, id of the text, place in the text, merged
piece) decides for each candidate whether it is skipped when the agenda comes to it, so a seed
always gives the same ids, and each occurrence of a word is drawn by itself, in other texts and in
the same one. A text without an id is drawn by its content. No dropout gives the ids of the library.

Merges cannot cross two neighbouring characters that no piece has side by side; texts are cut
there into segments. The agendas of all segments of some texts advance together, as the rows of a
matrix: each step takes the best candidate of every row, merges it and looks up its two new
neighbours, until no row has one left. Nothing is kept from text to text but the model's tables.
Segments above ``SHORT`` characters have agendas of their own. A character outside the vocabulary,
and the mark that stands for a blank when a text holds it itself, becomes its bytes.

Edge cases: null text is empty and has no ids; empty tables give an empty result; repeated rows
are encoded alike; other columns stay as they are (``encode`` replaces columns of its own names).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.lookup import OpenTable
from trendloom.llm.base import free, query, table
from trendloom.llm.records import tokenizer_path
from trendloom.llm.worker import kept, slices

BLANK = "▁"
SHORT = 40
WIDTHS = (4, 6, 8, 12, 20, SHORT)
NEVER = np.int32(1 << 30)
MASK = (1 << 64) - 1
PLACE, RANK, SEED = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x2545F4914F6CDD1D
ROOM = 1 << 18


def _mix(x: int) -> int:
    """64 well mixed bits of 64 bits; ``_mixed`` does the same to an array, in place."""
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Pairs:
    """Looks up pairs of numbers below 2^21, many at a time."""

    def __init__(self, known: dict[int, int]):
        """``known``: the first number times 2^21 and the second, to a value."""
        self.table = OpenTable(2 * len(known))
        self.table.add(np.array(list(known), np.int64), np.array(list(known.values()), np.int32))

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The value of each pair, -1 where there is none; negative numbers are in no pair."""
        keys = left.astype(np.int64) << 21 | right
        keys[(left < 0) | (right < 0)] = -1
        return self.table.find(keys)


class Merger:
    """Encodes texts under the draws of their own keys.

    A symbol is the number of a piece, from ``size`` on a character that pieces hold but that is
    none itself, or below zero a character that no piece holds.
    """

    def __init__(self, path: str, dropout: float, seed: int):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = len(model)
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        symbols = {names[i]: i for i in plain}
        inside = sorted({c for i in plain for c in names[i]}.difference(symbols))
        symbols |= {c: size + k for k, c in enumerate(inside)}
        self.size, self.symbols = size, symbols
        scores = sorted({-model.get_score(i) for i in plain if len(names[i]) > 1})
        rank = {s: k for k, s in enumerate(scores)}
        self.rank_of = np.full(size, NEVER)
        pairs: dict[tuple[int, int], int] = {}
        beside = set()
        for i in plain:
            name = names[i]
            beside |= {symbols[a] << 21 | symbols[b] for a, b in zip(name, name[1:], strict=False)}
            if len(name) > 1:
                self.rank_of[i] = rank[-model.get_score(i)]
                for j in range(1, len(name)):
                    a, b = symbols.get(name[:j]), symbols.get(name[j:])
                    if a is not None and b is not None:
                        pairs[a, b] = i
        self.unions = {a << 21 | b: i for (a, b), i in pairs.items()}
        self.pairs = Pairs(self.unions)
        self.beside = Pairs(dict.fromkeys(beside, 1))
        self.chars = np.arange(-1, -0x110001, -1, dtype=np.int32)
        for name, i in symbols.items():
            if len(name) == 1:
                self.chars[ord(name)] = i
        self.chars[0x20], self.chars[ord(BLANK)] = symbols.get(BLANK, -1 - 0x20), -1 - ord(BLANK)
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.extra = {size + k: c for k, c in enumerate(inside)}
        self.text = [b""] * size
        for i in plain:
            self.text[i] = names[i].replace(BLANK, " ").encode()
        for b, i in enumerate(self.bytes):
            self.text[i] = bytes([b])
        self.limit, self.seed = int(dropout * (1 << 32)), seed

    def _candidates(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The ranks of candidate merges; NEVER where there is none or where its hash skips it."""
        found = self.pairs.find(left, right)
        ranks = self.rank_of[found]
        ranks[found < 0] = NEVER
        if self.limit:
            there = np.flatnonzero(found >= 0)
            draws = keys[there] + at[there].astype(np.uint64) * np.uint64(PLACE)
            draws ^= ranks[there].astype(np.uint64) * np.uint64(RANK)
            ranks[there[_mixed(draws) >> np.uint64(32) < np.uint64(self.limit)]] = NEVER
        return ranks

    def _together(self, symbols: np.ndarray, first: np.ndarray, lengths: np.ndarray, keys: np.ndarray, width: int):
        """Merge segments of at most ``width`` symbols; yields (segments, numbers left, symbols left)."""
        columns = np.arange(width)
        rows = np.arange(len(first))
        inside = columns < lengths[:, None]
        own = np.where(inside, symbols[np.minimum(first[:, None] + columns, len(symbols) - 1)], -1)
        at = np.broadcast_to(columns.astype(np.int16), own.shape).copy()
        pair = inside[:, 1:]
        ranks = np.full((len(rows), width), NEVER)
        r, c = np.nonzero(pair)
        ranks[r, c] = self._candidates(own[r, c], own[r, c + 1], c, keys[r])
        left = lengths.copy()
        while True:
            best = ranks.argmin(axis=1)
            n = np.arange(len(rows))
            open_ = ranks[n, best] < NEVER
            if not open_.all():
                done = ~open_
                yield rows[done], left[done], own[done][columns < left[done][:, None]]
                rows, own, at, ranks, left, keys, best = (x[open_] for x in (rows, own, at, ranks, left, keys, best))
                n = np.arange(len(rows))
            if not len(rows):
                return
            own[n, best] = self.pairs.find(own[n, best], own[n, best + 1])
            beyond = columns[:-1] > best[:, None]
            for matrix, at_end in ((own, -1), (at, 0)):
                matrix[:, :-1] = np.where(beyond, matrix[:, 1:], matrix[:, :-1])
                matrix[:, -1] = at_end
            ranks[:, :-1] = np.where(beyond, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NEVER
            left -= 1
            after = np.minimum(best + 1, width - 1)
            ranks[n, best] = np.where(best + 1 < left, self._candidates(own[n, best], own[n, after], at[n, best], keys), NEVER)
            b = np.flatnonzero(best)
            before = best[b] - 1
            ranks[b, before] = self._candidates(own[b, before], own[b, before + 1], at[b, before], keys[b])

    def _rank(self, a: int, b: int, at: int, key: int) -> tuple[int, int]:
        """(rank, union) of one candidate; see ``_candidates``."""
        union = self.unions.get(a << 21 | b, -1) if a >= 0 and b >= 0 else -1
        if union < 0:
            return int(NEVER), -1
        rank = int(self.rank_of[union])
        if self.limit and _mix(((key + at * PLACE) & MASK) ^ ((rank * RANK) & MASK)) >> 32 < self.limit:
            return int(NEVER), -1
        return rank, union

    def _alone(self, symbols: np.ndarray, key: int) -> np.ndarray:
        """The same for one segment of any length, with a heap and links."""
        parts: list[int | None] = symbols.tolist()
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            rank, union = self._rank(parts[i], parts[i + 1], i, key)
            if union >= 0:
                agenda.append((rank, i, parts[i], parts[i + 1], union))
        heapify(agenda)
        while agenda:
            _, i, a, b, union = heappop(agenda)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = union, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0 and after[k] < n:
                    x, y = parts[k], parts[after[k]]
                    rank, union = self._rank(x, y, k, key)
                    if union >= 0:
                        heappush(agenda, (rank, k, x, y, union))
        return np.array([p for p in parts if p is not None], np.int32)

    def _spelled(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each symbol): what is no piece becomes its bytes."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        many = np.ones(len(symbols), np.int64)
        if not len(odd):
            return symbols, many
        kinds, which = np.unique(symbols[odd], return_inverse=True)
        spelled = [[self.bytes[b] for b in (self.extra[k] if k >= 0 else chr(-1 - k)).encode()] for k in kinds.tolist()]
        many[odd] = np.array([len(x) for x in spelled])[which]
        start = np.cumsum(many) - many
        out = np.repeat(symbols, many)
        for number, ids in enumerate(spelled):
            own = start[odd[which == number]]
            for k, i in enumerate(ids):
                out[own + k] = i
        return out, many

    def encode_all(self, texts: list[str], turns: list[int]) -> list[np.ndarray]:
        """The ids of each text under the draws of its key."""
        out: list[np.ndarray] = []
        some: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            some.append(i)
            size += len(text)
            if size > ROOM or i == len(texts) - 1:
                out += self._encode([texts[j] for j in some], [turns[j] for j in some])
                some, size = [], 0
        return out

    def segments(self, texts: Sequence[str], turns: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, first symbol, length and key of every segment) of texts, none of them empty."""
        points = np.frombuffer(" ".join(["", *texts]).encode("utf-32-le"), "<u4")
        symbols = self.chars[points]
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
        cut = np.ones(len(symbols) + 1, bool)
        cut[1:-1] = self.beside.find(symbols[:-1], symbols[1:]) < 0
        cut[starts] = True
        borders = np.flatnonzero(cut)
        first, lengths = borders[:-1], np.diff(borders)
        owner = np.searchsorted(starts, first, "right") - 1
        bases = np.array([_mix((t ^ (self.seed * SEED)) & MASK) for t in turns], np.uint64)
        keys = bases[owner] + (first - starts[owner]).astype(np.uint64) * np.uint64(PLACE)
        return symbols, first, lengths, keys

    def _encode(self, texts: list[str], turns: list[int]) -> list[np.ndarray]:
        full = [i for i, t in enumerate(texts) if t]
        none = np.zeros(0, np.int32)
        if not full:
            return [none] * len(texts)
        own = [texts[i] for i in full]
        symbols, first, lengths, keys = self.segments(own, [turns[i] for i in full])
        found = [(np.flatnonzero(lengths == 1), np.ones(int((lengths == 1).sum()), np.int64), symbols[first[lengths == 1]])]
        under = 1
        for width in WIDTHS:
            chosen = np.flatnonzero((lengths > under) & (lengths <= width))
            for at in range(0, len(chosen), ROOM // width):
                part = chosen[at : at + ROOM // width]
                for rows, left, flat in self._together(symbols, first[part], lengths[part], keys[part], width):
                    found.append((part[rows], left, flat))
            under = width
        for i in np.flatnonzero(lengths > SHORT).tolist():
            flat = self._alone(symbols[first[i] : first[i] + lengths[i]], int(keys[i]))
            found.append((np.array([i]), np.array([len(flat)]), flat))
        counts = np.zeros(len(first), np.int64)
        for rows, left, _ in found:
            counts[rows] = left
        places = np.concatenate([[0], np.cumsum(counts)])
        merged = np.empty(places[-1], np.int32)
        for rows, left, flat in found:
            begin = np.cumsum(left) - left
            merged[np.repeat(places[rows] - begin, left) + np.arange(len(flat))] = flat
        ids, many = self._spelled(merged)
        spelled = np.concatenate([[0], np.cumsum(many)])
        starts = np.cumsum([0, *[len(t) + 1 for t in own]])
        ends = spelled[places[np.searchsorted(first, starts)]]
        out = [none] * len(texts)
        for i, a, b in zip(full, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[i] = ids[a:b]
        return out

    def encode(self, text: str, turn: int) -> list[int]:
        return self.encode_all([text], [turn])[0].tolist()

    def decode(self, ids) -> str:
        own = self.text
        return b"".join([own[i] for i in ids])[1:].decode()


def _encoder(path: str, dropout: float, seed: int, names: list[str]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = kept(("pieces", path, dropout, seed), lambda: Merger(path, dropout, seed))
        for batch in batches:
            for part in slices(batch, 0, 1000, 1 << 20):
                text = [t or "" for t in part.column(0).to_pylist()]
                ids = merger.encode_all(text, part.column(1).to_pylist())
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
                flat = np.concatenate([*ids, np.zeros(0, np.int32)])
                lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())).cast(pa.list_(pa.int32()))
                back = pa.array([merger.decode(i.tolist()) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[2:], lists, back], names=names)

    return encode


def encode(
    docs: DataFrame,
    model: str,
    dropout: float = 0.1,
    seed: int = 0,
    key: str = "doc_id",
    ids: str = "piece_ids",
    decoded: str = "decoded",
) -> DataFrame:
    """``docs`` with the columns ``ids`` and ``decoded``, the text that the ids give back."""
    kept_columns = [c for c in docs.columns if c not in (ids, decoded)]
    turn = F.xxhash64(F.col(key), F.when(F.col(key).isNull(), F.col("text")))
    given = docs.select(F.col("text").alias(free("_text", kept_columns)), turn.alias(free("_turn", kept_columns)), *kept_columns)
    fields = T.StructType(given.schema.fields[2:]).add(ids, T.ArrayType(T.IntegerType())).add(decoded, "string")
    return given.mapInArrow(_encoder(model, dropout, seed, fields.names), fields)


def digest(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_pieces, ids_sha256, decoded_sha256, lossless) of encoded texts."""
    text = F.coalesce("text", F.lit(""))
    return encoded.select(
        key,
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.sha2(F.concat_ws(",", F.col("piece_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == text).alias("lossless"),
    )


@query("op9_merge_dropout")
def merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded with dropout and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(encode(docs, tokenizer_path("piece_bpe_32k.model")))
