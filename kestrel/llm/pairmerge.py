"""Greedy pair merging for many short symbol sequences at once.

The byte-level and the piece tokenizers differ only in where their symbols and
merge ranks come from; both repeatedly join the neighbouring pair of best rank,
leftmost first.  Here each round makes one such merge in every sequence of a
padded matrix; sequences over ``WIDEST`` symbols use a heap instead.  Results of
whole slices are kept in a bounded cache per worker process."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa

SYMBOL_BITS = 21
PAD = (1 << SYMBOL_BITS) - 1            # stands outside every sequence; takes part in no pair
NO_RANK = np.uint32(0xFFFFFFFF)
WIDEST = 64
CACHE_SLICES, CACHE_TOKENS = 100_000, 1_000_000
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_MATRIX_CELLS = 1 << 18


class PairTable:
    """(left symbol, right symbol) -> (rank, merged symbol), open addressing."""

    def __init__(self, left, right, rank, merged):
        keys = self._key(np.asarray(left), np.asarray(right))
        bits = max(8, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full((1 << bits) + 1, _FREE, np.uint64)      # the last slot stays free: "no pair"
        self.rank = np.full((1 << bits) + 1, NO_RANK, np.uint32)
        self.merged = np.zeros((1 << bits) + 1, np.int32)
        self.none = 1 << bits
        rank, merged = np.asarray(rank, np.uint32), np.asarray(merged, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] == _FREE
            some = todo[free]
            self.keys[at[some]] = keys[some]
            self.rank[at[some]], self.merged[at[some]] = rank[some], merged[some]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & self.mask
        self._plain: dict[int, tuple[int, int]] | None = None

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(SYMBOL_BITS) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys * _SPREAD >> self.shift).astype(np.int64)

    def slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in ``rank`` and ``merged``; absent pairs get a place without rank."""
        keys = self._key(left, right)
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, at, self.none)
        todo = np.flatnonzero((found != keys) & (found != _FREE))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit & (found != _FREE)]
        return out

    def plain(self) -> dict[int, tuple[int, int]]:
        if self._plain is None:
            used = np.flatnonzero(self.keys != _FREE)
            self._plain = dict(zip(self.keys[used].tolist(), zip(self.rank[used].tolist(), self.merged[used].tolist())))
        return self._plain


def merge_all(table: PairTable, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges every sequence (``counts`` symbols each, one after another) to the
    end: (symbols left, their counts)."""
    counts = np.asarray(counts, np.int64)
    upto = np.concatenate([[0], np.cumsum(counts)])
    left = counts.copy()
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    low = 0
    for width in (1, 2, 4, 8, 16, 32, WIDEST):
        rows = np.flatnonzero((counts > low) & (counts <= width))
        low = width
        step = max(1, _MATRIX_CELLS // (width + 2))
        for a in range(0, len(rows), step):
            some = rows[a:a + step]
            inside = np.arange(width) < counts[some, None]
            grid = np.full((len(some), width + 2), PAD, np.int32)
            grid[:, 1:-1][inside] = symbols[np.repeat(upto[some], counts[some]) + _within(counts[some])]
            if width > 1:
                _merge_grid(table, grid)
            live = grid != PAD
            left[some] = live.sum(1)
            parts.append((some, left[some], grid[live]))
    for r in np.flatnonzero(counts > WIDEST).tolist():
        done = _merge_long(table, symbols[upto[r]:upto[r + 1]].tolist())
        left[r] = len(done)
        parts.append((np.array([r]), left[r:r + 1], np.array(done, np.int32)))
    start = np.cumsum(left) - left
    out = np.empty(int(left.sum()), np.int32)
    for rows, sizes, flat in parts:
        out[np.repeat(start[rows], sizes) + _within(sizes)] = flat
    return out, left


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each run of ``counts`` entries."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _merge_grid(table: PairTable, grid: np.ndarray) -> None:
    """In place; column 0 and the last one hold PAD, merged-away symbols become PAD."""
    n, w = grid.shape
    at = table.slots(grid[:, :-1].ravel(), grid[:, 1:].ravel())
    rank = table.rank[at].reshape(n, w - 1)
    becomes = table.merged[at].reshape(n, w - 1)
    after = np.tile(np.arange(1, w + 1, dtype=np.int8), (n, 1))
    before = np.tile(np.arange(-1, w - 1, dtype=np.int8), (n, 1))
    rows = np.arange(n)
    while len(rows):
        best = rank if len(rows) == n else rank[rows]
        i = best.argmin(1)
        go = best[np.arange(len(rows)), i] != NO_RANK
        rows, i = rows[go], i[go]
        if not len(rows):
            break
        j = after[rows, i].astype(np.int64)
        k = after[rows, j].astype(np.int64)
        h = before[rows, i].astype(np.int64)
        new = becomes[rows, i]
        grid[rows, i], grid[rows, j] = new, PAD
        after[rows, i], before[rows, k] = k, i
        rank[rows, j] = NO_RANK
        both = table.slots(np.concatenate([new, grid[rows, h]]), np.concatenate([grid[rows, k], new]))
        m = len(rows)
        rank[rows, i], becomes[rows, i] = table.rank[both[:m]], table.merged[both[:m]]
        rank[rows, h], becomes[rows, h] = table.rank[both[m:]], table.merged[both[m:]]


def _merge_long(table: PairTable, s: list[int]) -> list[int]:
    pairs, n = table.plain(), len(s)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int, j: int) -> None:
        found = pairs.get(s[i] << SYMBOL_BITS | s[j])
        if found is not None:
            heapq.heappush(heap, (found[0], i, j, s[i], s[j], found[1]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, j, a, b, new = heapq.heappop(heap)
        if s[i] != a or s[j] != b or after[i] != j:
            continue
        s[i], s[j], k = new, PAD, after[j]
        after[i] = k
        if k < n:
            before[k] = i
            offer(i, k)
        if before[i] >= 0:
            offer(before[i], i)
    return [x for x in s if x != PAD]


class SliceCache:
    """Symbols of whole slices.  ``encode`` turns an array of distinct slices into
    (flat ids, counts); a slice met again, in this or a later buffer of the task,
    is only looked up.  The cache is emptied at its size limit and at the end of a task."""

    def __init__(self, encode: Callable[[pa.LargeBinaryArray], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.flat, self.upto = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __call__(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per slice) of the slices that tile ``data`` from ``starts``."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        bounds = pa.array(np.append(starts, len(data)).astype(np.int64))
        slices = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, bounds.buffers()[1], pa.py_buffer(data)])
        coded = slices.dictionary_encode()
        if len(self.slot) > CACHE_SLICES or len(self.flat) > CACHE_TOKENS:
            self.clear()
        values = coded.dictionary.to_pylist()
        known = np.fromiter(map(self.slot.get, values, [-1] * len(values)), np.int64, len(values))
        new = np.flatnonzero(known < 0)
        if len(new):
            flat, sizes = self.encode(coded.dictionary.take(pa.array(new)))
            known[new] = len(self.slot) + np.arange(len(new))
            self.slot.update(zip([values[i] for i in new.tolist()], known[new].tolist()))
            self.flat = np.concatenate([self.flat, flat])
            self.upto = np.concatenate([self.upto, self.upto[-1] + np.cumsum(sizes)])
        lists = pa.LargeListArray.from_arrays(pa.array(self.upto), pa.array(self.flat)).take(pa.array(known[coded.indices.to_numpy()]))
        return lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())


class BytePool:
    """Byte strings by number; ``joined`` writes those of many numbers into one buffer."""

    def __init__(self, values: list[bytes]):
        self.values = pa.array(values, pa.large_binary())

    def joined(self, numbers: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """(bytes one after another, offsets: n+1 entries)."""
        picked = self.values.take(pa.array(numbers))
        raw = picked.buffers()[2] if len(picked) else None
        return memoryview(raw if raw is not None else b""), np.frombuffer(picked.buffers()[1], np.int64)[:len(picked) + 1] \
            if len(picked) else np.zeros(1, np.int64)


def binary_parts(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array without nulls."""
    off = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    raw = values.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]
