"""Pair merging of many short words at once, for BPE vocabularies.

Every row of a matrix is a word's symbols.  A round finds each row's best
adjacent pair (lowest rank, leftmost among equals), merges it and closes the
gap, for all rows that still have one.  The order of merges within a word is
that of an agenda by score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import mix64, word_array

NONE = np.int64(1) << 40


def pair_arrays(pairs: dict[tuple[int, int], tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Both ids of each pair in one number, and its rank and merged id in another."""
    n = len(pairs)
    return np.fromiter((a << 32 | b for a, b in pairs), np.int64, n), np.fromiter((r << 32 | m for r, m in pairs.values()), np.int64, n)


class BatchMerger:
    """``pairs`` maps two symbol ids to (rank, merged id), or holds them as ``pair_arrays`` gives them."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]] | tuple[np.ndarray, np.ndarray]) -> None:
        keys, values = pair_arrays(pairs) if isinstance(pairs, dict) else pairs
        n = len(keys)
        self.mask = np.int64((1 << (max(n, 1) * 4).bit_length()) - 1)
        self.keys = np.full(int(self.mask) + 1, -1, np.int64)
        self.values = np.full(int(self.mask) + 1, NONE << 20, np.int64)
        slot = self._slot(keys)
        todo = np.arange(n)
        while len(todo):  # linear probing: of those that want a free slot one gets it, the others go on
            free = todo[self.keys[slot[todo]] < 0]
            self.keys[slot[free]] = keys[free]
            placed = todo[self.keys[slot[todo]] == keys[todo]]
            self.values[slot[placed]] = values[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return mix64(keys).astype(np.int64) & self.mask

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE << 20)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out

    def _merge(self, rows: np.ndarray) -> np.ndarray:
        """Rows of ids, padded with -1 at the end."""
        done = rows
        active = np.arange(len(rows))
        at = np.arange(rows.shape[1])
        work = rows
        pairs = self._pairs(work)
        while len(active):
            k = pairs.argmin(axis=1)
            best = pairs[np.arange(len(active)), k]
            ended = best >= NONE << 20
            if ended.any():
                done[active[ended]] = work[ended]
                going = ~ended
                active, work, pairs, k, best = active[going], work[going], pairs[going], k[going], best[going]
                if not len(active):
                    break
            source = np.minimum(at[None, :] + (at[None, :] > k[:, None]), len(at) - 1)
            short = np.take_along_axis(work, source, axis=1)
            short[:, -1] = -1
            short[np.arange(len(active)), k] = best & 0xFFFFFFFF  # the merged id
            work = short
            pairs = np.take_along_axis(pairs, source[:, : pairs.shape[1]].clip(max=pairs.shape[1] - 1), axis=1)
            pairs[:, -1] = NONE << 20
            row = np.arange(len(active))
            for side in (k - 1, k):  # only the merged symbol's two neighbours are new
                ok = (side >= 0) & (side < pairs.shape[1])
                r, s = row[ok], side[ok]
                a, b = work[r, s], work[r, s + 1]
                pairs[r, s] = np.where((a >= 0) & (b >= 0), self._find(a << 32 | (b & 0xFFFFFFFF)), NONE << 20)
        return done

    def _pairs(self, rows: np.ndarray) -> np.ndarray:
        a, b = rows[:, :-1], rows[:, 1:]
        found = self._find((a << 32 | (b & 0xFFFFFFFF)).ravel()).reshape(a.shape)
        return np.where((a >= 0) & (b >= 0), found, NONE << 20)

    def __call__(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words' symbols in one array, and each word's length: the same after all merges.

        Symbols below 0 merge with nothing; -1 may not occur.
        """
        starts = np.cumsum(lengths) - lengths
        counts = np.zeros(len(lengths), np.int64)
        parts = []
        lo = 0
        for hi in (4, 8, 12, 16, 24, 40, 100, 1000, int(lengths.max(initial=0))):
            group = np.flatnonzero((lengths > lo) & (lengths <= hi))
            size = max(1, (1 << 16) // (hi + 1))
            for part in (group[j : j + size] for j in range(0, len(group), size)):
                rows = np.full((len(part), hi + 1), -1, np.int64)
                rows[np.arange(hi + 1)[None, :] < lengths[part][:, None]] = flat[ranges(starts[part], lengths[part])]
                merged = self._merge(rows)
                counts[part] = (merged != -1).sum(axis=1)
                parts.append((part, merged[merged != -1]))
            lo = max(lo, hi)
        begin = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        for part, ids in parts:
            out[ranges(begin[part], counts[part])] = ids
        return out, counts


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one after the other."""
    total = np.cumsum(counts)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts - (total - counts), counts)


def distinct_words(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For byte ranges: the place of the first range of each distinct word, every range's number among them, and their bytes."""
    coded = word_array(flat, start, end).dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    one = np.zeros(len(coded.dictionary), np.int64)
    one[number[::-1]] = np.arange(len(number))[::-1]
    return one, number, coded.dictionary
