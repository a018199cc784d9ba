"""Weighted acyclic automata over sequences of symbols, kept by levels in numpy arrays.

The states of a level are the distinct beginnings of that length, in the byte
order of their symbols; a state has one arc from its parent, with its symbol.
``ends`` is how many counted sequences end in a state, and the weight of a
state, the sum over all sequences that begin with it, is what a transducer
gives out for that beginning.  Construction takes sorted sequences, whole
batches at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NONE = pa.array([], pa.large_binary())


def sorted_symbols(symbols: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct symbols in byte order, and the place of each of ``symbols`` among them."""
    coded = symbols.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), rank[coded.indices.to_numpy(zero_copy_only=False)]


def _grouped(parent: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Arcs from one state with one symbol are one: their distinct keys in order, and each arc's place among them."""
    return np.unique(parent.astype(np.int64) << 32 | label, return_inverse=True)


@dataclass
class Counts:
    """symbols: all that occur, in byte order.  By level: each state's parent (a place in the level before) and symbol, and ``ends``."""

    symbols: pa.Array
    parent: list[np.ndarray]
    label: list[np.ndarray]
    ends: list[np.ndarray]

    @staticmethod
    def empty(depth: int) -> Counts:
        none = [np.zeros(0, np.int64)] * depth
        return Counts(NONE, none, none, none)

    @staticmethod
    def of_sorted(symbols: pa.Array, rows: np.ndarray, weights: np.ndarray) -> Counts:
        """From distinct sequences in order: a row each of places in ``symbols``, with -1 after a shorter one's end."""
        n, depth = rows.shape
        new, state = np.zeros(n, bool), np.zeros(n, np.int64)
        parents, labels, ends = [], [], []
        if n:
            new[0] = True
        for d in range(depth):
            there = rows[:, d] >= 0
            new[1:] |= rows[1:, d] != rows[:-1, d]
            begins = new & there
            parents.append(state[begins])
            labels.append(rows[begins, d])
            state = np.cumsum(begins) - 1
            last = there & (rows[:, d + 1] < 0 if d + 1 < depth else True)
            at = np.zeros(len(labels[-1]), np.int64)
            np.add.at(at, state[last], weights[last])
            ends.append(at)
        return Counts(symbols, parents, labels, ends)

    @staticmethod
    def union(parts: Sequence[Counts]) -> Counts:
        """States that are reached by the same symbols become one, level by level; what ends in them is summed."""
        if len(parts) == 1:
            return parts[0]
        symbols, place = sorted_symbols(pa.concat_arrays([p.symbols for p in parts]))
        first = np.cumsum([0, *(len(p.symbols) for p in parts)])
        states = [np.zeros(1, np.int64) for _ in parts]
        parents, labels, ends = [], [], []
        for d in range(len(parts[0].label)):
            keys, mine = _grouped(np.concatenate([s[p.parent[d]] for s, p in zip(states, parts)]), np.concatenate([place[f + p.label[d]] for f, p in zip(first, parts)]))
            parents.append(keys >> 32)
            labels.append(keys & 0xFFFFFFFF)
            at = np.zeros(len(keys), np.int64)
            np.add.at(at, mine, np.concatenate([p.ends[d] for p in parts]))
            ends.append(at)
            sizes = np.cumsum([0, *(len(p.label[d]) for p in parts)])
            states = [mine[a:b] for a, b in zip(sizes, sizes[1:])]
        return Counts(symbols, parents, labels, ends)

    def weights(self) -> list[np.ndarray]:
        """By level, the sums over all sequences that begin with a state's symbols."""
        out = [e.copy() for e in self.ends]
        for d in range(len(out) - 1, 0, -1):
            np.add.at(out[d - 1], self.parent[d], out[d])
        return out

    def compose(self, asked: Counts, weights: list[np.ndarray]) -> list[np.ndarray]:
        """For each state of ``asked``, the weight of the state here that the same symbols lead to, or 0: pairs of states, level by level."""
        symbols, place = sorted_symbols(pa.concat_arrays([self.symbols, asked.symbols]))
        here, there = place[: len(self.symbols)], place[len(self.symbols) :]
        pair, found = np.zeros(1, np.int64), []
        for d in range(len(asked.label)):
            mine = self.parent[d].astype(np.int64) << 32 | here[self.label[d]]  # ascending, as states are in order
            want_from = pair[asked.parent[d]]
            want = want_from << 32 | there[asked.label[d]]
            at = np.searchsorted(mine, want)
            hit = (want_from >= 0) & (at < len(mine))
            hit[hit] = mine[at[hit]] == want[hit]
            pair = np.where(hit, at, -1)
            out = np.zeros(len(want), np.int64)
            out[hit] = weights[d][at[hit]]
            found.append(out)
        return found

    def paths(self, depth: int, states: np.ndarray) -> np.ndarray:
        """The symbols' places along the way to states of a level (from 0), a row each."""
        out = np.empty((len(states), depth + 1), np.int64)
        for d in range(depth, -1, -1):
            out[:, d] = self.label[d][states]
            states = self.parent[d][states]
        return out

    def sequences(self) -> tuple[np.ndarray, np.ndarray]:
        """All counted sequences in order, as ``of_sorted`` takes them, and how often each occurs."""
        depth, rows, counts = len(self.label), [], []
        for d, ends in enumerate(self.ends):
            states = np.flatnonzero(ends)
            padded = np.full((len(states), depth), -1, np.int64)
            padded[:, : d + 1] = self.paths(d, states)
            rows.append(padded)
            counts.append(ends[states])
        every = np.concatenate(rows)
        order = np.lexsort(every.T[::-1])
        return every[order], np.concatenate(counts)[order]

    def cut(self, splitters: Sequence[tuple[bytes, ...]]) -> list[tuple[int, Counts]]:
        """(number, automaton) of the ranges between ascending splitters that hold any sequence; a splitter begins its range."""
        extra = pa.array([x for s in splitters for x in s], pa.large_binary())
        symbols, place = sorted_symbols(pa.concat_arrays([self.symbols, extra]))
        rows, counts = self.sequences()
        rows = np.where(rows >= 0, place[rows], -1)
        at, bounds = len(self.symbols), []
        for s in splitters:
            lo, hi = 0, len(rows)
            for d in range(rows.shape[1]):  # those that are below it, one symbol after the other
                want = place[at + d] if d < len(s) else -1
                lo, hi = lo + np.searchsorted(rows[lo:hi, d], want), lo + np.searchsorted(rows[lo:hi, d], want, side="right")
            bounds.append(lo)
            at += len(s)
        edges = [0, *bounds, len(rows)]
        return [(k, with_own_symbols(symbols, rows[lo:hi], counts[lo:hi])) for k, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]

    def dump(self) -> bytes:
        """Compressed bytes: the symbols, and by level the number of arcs of each state, the arcs' symbols and ``ends``."""
        lengths = pc.binary_length(self.symbols).to_numpy(zero_copy_only=False)
        arrays, above = [_narrow(lengths)], 1
        for parent, label, ends in zip(self.parent, self.label, self.ends):
            arrays += [_narrow(np.bincount(parent, minlength=above)), _narrow(label), _narrow(ends)]
            above = len(label)
        head = np.array([(a.dtype.itemsize, len(a)) for a in arrays], np.uint64)
        text = b"".join(self.symbols.to_pylist())
        raw = b"".join([np.uint64(len(arrays)).tobytes(), head.tobytes(), *(a.tobytes() for a in arrays), text])
        return np.uint64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)

    @staticmethod
    def load(data: bytes) -> Counts:
        raw = pa.decompress(data[8:], decompressed_size=int(np.frombuffer(data, np.uint64, 1)[0]), codec="zstd", asbytes=True)
        n = int(np.frombuffer(raw, np.uint64, 1)[0])
        head, at, arrays = np.frombuffer(raw, np.uint64, 2 * n, 8).astype(np.int64).reshape(n, 2), 8 + 16 * n, []
        for size, count in head.tolist():
            arrays.append(np.frombuffer(raw, f"<u{size}", count, at).astype(np.int64))
            at += size * count
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(arrays[0])])
        symbols = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(arrays[0]), [None, pa.py_buffer(offsets), pa.py_buffer(raw[at:])])
        levels = [arrays[1 + 3 * d : 4 + 3 * d] for d in range((n - 1) // 3)]
        return Counts(symbols, [np.repeat(np.arange(len(arcs)), arcs) for arcs, _, _ in levels], [x[1] for x in levels], [x[2] for x in levels])


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def with_own_symbols(symbols: pa.Array, rows: np.ndarray, weights: np.ndarray) -> Counts:
    """``of_sorted``, with only those symbols that the rows use."""
    used = np.zeros(len(symbols) + 1, bool)
    used[rows.ravel()] = True  # -1 falls on the last
    used[-1] = False
    number = np.cumsum(used) - 1
    number[-1] = -1
    return Counts.of_sorted(symbols.take(pa.array(np.flatnonzero(used))), number[rows], weights)
