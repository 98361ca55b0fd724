"""Many strings looked for at once: a trie with failure links, run over whole Arrow buffers.

The strings are compiled on the driver into flat arrays: the edges of the trie, for each state the
state to fall back to, and the string that ends there. A batch of texts is one buffer of bytes with
a byte between texts that no UTF-8 text holds. It is cut into stretches of equal length that advance
together, a byte a step, so a step is a few array lookups whatever the number of strings. Stretches
begin earlier than they count, by the longest string, so that no match is lost at a border.

States of depth one and two depend on the last two bytes only and come from one table of 65,536; an
edge is looked up for deeper states alone. The arrays grow with the strings' bytes and with nothing
else, so one way serves a list of any length. They travel with the function; Spark broadcasts what
is large.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.lookup import OpenTable

BORDER = 255
STRETCH = 256
SLICE = 8 << 20


class Matcher:
    """``strings``: what to look for; a match names a string by its place in that list."""

    def __init__(self, strings: Sequence[str]):
        self.longest = max((len(s.encode()) for s in strings), default=0)
        self.empty = [i for i, s in enumerate(strings) if not s]
        children: list[dict[int, int]] = [{}]
        ends: dict[int, list[int]] = {}
        for number, string in enumerate(strings):
            node = 0
            for byte in string.encode():
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            if node:
                ends.setdefault(node, []).append(number)
        self._compile(children, ends)

    def _compile(self, children: list[dict[int, int]], ends: dict[int, list[int]]) -> None:
        """Number the states by depth and lay edges, failures and ends out as arrays."""
        size = len(children)
        order, parent, depth = [0], np.zeros(size, np.int64), np.zeros(size, np.int64)
        fail = np.zeros(size, np.int64)
        waiting = deque([0])
        while waiting:
            node = waiting.popleft()
            for byte, child in children[node].items():
                depth[child] = depth[node] + 1
                parent[child] = node
                back = int(fail[node])
                while back and byte not in children[back]:
                    back = int(fail[back])
                fail[child] = children[back].get(byte, 0) if node else 0
                order.append(child)
                waiting.append(child)
        number = np.zeros(size, np.int64)
        number[order] = np.arange(size)
        self.deep = int((depth < 2).sum())
        self.fail = number[fail[order]].astype(np.int32)
        self.pairs = np.zeros(1 << 16, np.int32)
        for byte, child in children[0].items():
            self.pairs[byte::256] = number[child]
        for byte, child in children[0].items():
            for second, grandchild in children[child].items():
                self.pairs[byte << 8 | second] = number[grandchild]
        edges = [(int(number[n]) << 8 | b, int(number[c])) for n in order if depth[n] >= 2 for b, c in children[n].items()]
        self.edges = OpenTable(len(edges))
        if edges:
            keys, targets = zip(*edges)
            self.edges.add(np.array(keys, np.int64), np.array(targets, np.int32))
        # The strings that end in a state are a run of ``names``; ``shorter`` is the next state, on the
        # way of failures, in which one ends.
        self.first, self.many = np.zeros(size, np.int64), np.zeros(size, np.int64)
        names: list[int] = []
        for node, own in ends.items():
            self.first[number[node]], self.many[number[node]] = len(names), len(own)
            names += own
        self.names = np.array(names, np.int64)
        self.shorter = np.zeros(size, np.int32)
        for state in range(1, size):
            back = self.fail[state]
            self.shorter[state] = back if self.many[back] else self.shorter[back]
        self.ends = (self.many > 0) | (self.shorter > 0)

    def _scan(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the last byte, state) wherever a string ends; order is that of the steps."""
        warm = max(self.longest - 1, 0)
        length = max(STRETCH, 2 * self.longest)
        lanes = -(-len(data) // length)
        padded = np.full(warm + lanes * length, BORDER, np.uint8)
        padded[warm : warm + len(data)] = data
        view = np.lib.stride_tricks.as_strided(padded, (lanes, warm + length), (length, 1))
        steps = np.ascontiguousarray(view.T)
        state = np.zeros(lanes, np.int32)
        before = np.full(lanes, BORDER, np.int64)
        places, states = [], []
        for k in range(warm + length):
            byte = steps[k].astype(np.int64)
            new = self.pairs[before << 8 | byte]
            deep = np.flatnonzero(state >= self.deep)
            at = state[deep]
            while len(deep):
                found = self.edges.find(at.astype(np.int64) << 8 | byte[deep])
                new[deep[found >= 0]] = found[found >= 0]
                at = self.fail[at]
                left = (found < 0) & (at >= self.deep)
                deep, at = deep[left], at[left]
            state, before = new, byte
            if k >= warm:
                hit = np.flatnonzero(self.ends[state])
                if len(hit):
                    places.append(hit * length + (k - warm))
                    states.append(state[hit])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *places]), np.concatenate([none, *states])

    def _parts(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the first text, bytes with a border after each text, where texts begin)."""
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        totals = np.concatenate([[0], np.cumsum(lengths + 1)])
        at = 0
        while at < len(texts):
            end = max(int(np.searchsorted(totals, totals[at] + SLICE, "right")) - 1, at + 1)
            part = pc.fill_null(texts.slice(at, end - at), "").cast(pa.large_string())
            rows = pa.LargeListArray.from_arrays(pa.array([0, len(part)], pa.int64()), part)
            joined = pc.binary_join(rows, pa.scalar("\0", pa.large_string()))
            data = np.append(np.frombuffer(joined.buffers()[2], np.uint8)[: totals[end] - totals[at] - 1], np.uint8(0))
            starts = totals[at:end] - totals[at]
            data[starts[1:] - 1] = BORDER
            data[-1] = BORDER
            yield at, data, starts
            at = end

    def any(self, texts: pa.Array) -> pa.Array:
        """Whether each text holds a string; null for null texts."""
        out = np.full(len(texts), bool(self.empty))
        if self.longest:
            for first, data, starts in self._parts(texts):
                places, _ = self._scan(data)
                out[first + np.searchsorted(starts, places, "right") - 1] = True
        return pa.array(out, mask=pc.is_null(texts).to_numpy(zero_copy_only=False))

    def matches(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, string) by number, in ascending order."""
        full = np.flatnonzero(pc.is_valid(texts).to_numpy(zero_copy_only=False))
        found = [np.add.outer(full << 32, np.array(self.empty, np.int64)).ravel()]
        if self.longest:
            for first, data, starts in self._parts(texts):
                places, states = self._scan(data)
                rows = first + np.searchsorted(starts, places, "right") - 1
                # One entry per text and state, before states are spelled out into strings.
                both = np.unique(rows << 32 | states)
                while len(both):
                    rows, states = both >> 32, both & 0xFFFFFFFF
                    many = self.many[states]
                    begin = np.cumsum(many) - many
                    own = self.names[np.repeat(self.first[states] - begin, many) + np.arange(int(many.sum()))]
                    found.append(np.unique(np.repeat(rows, many) << 32 | own))
                    back = self.shorter[states]
                    both = np.unique((rows << 32 | back)[back > 0])
        every = np.unique(np.concatenate(found))
        return every >> 32, every & 0xFFFFFFFF


def holds_any(text: Column, strings: Sequence[str]) -> Column:
    """True where the text holds at least one of the strings; null text stays null."""
    matcher = Matcher(sorted(set(strings)))

    @F.arrow_udf(T.BooleanType())
    def holds(texts: pa.Array) -> pa.Array:
        return matcher.any(texts)

    return holds(text)


def groups_held(text: Column, groups: Sequence[Sequence[str]]) -> Column:
    """The numbers of the groups of which the text holds a string, as an array; null text holds none."""
    of: dict[str, list[int]] = {}
    for number, strings in enumerate(groups):
        for string in set(strings):
            of.setdefault(string, []).append(number)
    names = sorted(of)
    matcher = Matcher(names)
    many = np.array([len(of[s]) for s in names], np.int64)
    first = np.cumsum(many) - many
    flat = np.array([g for s in names for g in of[s]], np.int64)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def held(texts: pa.Array) -> pa.Array:
        rows, strings = matcher.matches(texts)
        n = many[strings]
        begin = np.cumsum(n) - n
        own = flat[np.repeat(first[strings] - begin, n) + np.arange(int(n.sum()))]
        every = np.unique(np.repeat(rows, n) << 32 | own)
        ends = np.searchsorted(every >> 32, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(every & 0xFFFFFFFF, pa.int32()))

    return held(text)
