"""Vectorised text kernels used inside Arrow map tasks.

A column of texts is viewed as one byte buffer plus row offsets; word
boundaries, word hashes and hashes of word runs are computed for all rows of a
chunk at once.  Chunks are cut by bytes (``CHUNK_BYTES``; one longer text is a
chunk of its own), so task memory does not depend on how many rows an Arrow
batch holds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK_BYTES = 2 << 20

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE_CODE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE, _RUN_BASE = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 2 ** 64)


class _Powers:
    """base^i and base^-i modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inv = base, U64(_inverse(int(base)))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, self.base, np.uint64)]))
                self.down = np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, self.inv, np.uint64)]))
        return self.up, self.down


_POW, _RUN_POW = _Powers(_BASE), _Powers(_RUN_BASE)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (every output bit depends on every input bit)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def byte_table(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Boolean table of the 256 bytes: true outside the given closed ranges."""
    t = np.ones(256, bool)
    for a, b in ranges:
        t[a:b + 1] = False
    return t


#: words [^\x20\x09-\x0D]+ and words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
SPACE_WORD = byte_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM_WORD = byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    _, off, data = col.buffers()
    n = len(col)
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges holding at most ``limit`` bytes each (or one row)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


class Chunk:
    """Some rows of an Arrow batch: ``rows`` (the batch slice), ``data`` (uint8)
    and ``offsets`` of the text column."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets, self.n = rows, data, offsets, len(offsets) - 1

    def column(self, name: str):
        return self.rows.column(self.rows.schema.get_field_index(name))

    def texts(self) -> Iterator[bytes]:
        raw = self.data.tobytes()
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            yield raw[a:b]

    def words(self, table: np.ndarray, lower: bool = True) -> Words:
        return Words(LOWER[self.data] if lower else self.data, self.offsets, table)


def chunks(batch: pa.RecordBatch, text: str) -> Iterator[Chunk]:
    data, offsets = column_bytes(batch.column(batch.schema.get_field_index(text)))
    for a, b in row_groups(offsets):
        lo, hi = offsets[a], offsets[b]
        yield Chunk(batch.slice(a, b - a), data[lo:hi], offsets[a:b + 1] - lo)


class Words:
    """Words of all rows: ``starts``/``ends`` (bytes), ``row_off`` (first word of
    each row, n+1 entries)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data = data
        inside = table[data]
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[0] = after[-1] = False
            before[1:], after[:-1] = inside[:-1], inside[1:]
            first = offsets[:-1]
            first = first[first < len(data)]
            before[first] = False
            last = offsets[1:] - 1
            after[last[last >= 0]] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.row_off = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.row_off)

    def __len__(self) -> int:
        return len(self.starts)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        return span_hashes(self.data, self.starts, self.ends)

    def index_in_row(self) -> np.ndarray:
        return np.arange(len(self.starts)) - np.repeat(self.row_off[:-1], self.counts)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from one running sum over the buffer."""
    up, down = _POW.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE_CODE[data] * up[:len(data)], out=total[1:])
        h = (total[ends] - total[starts]) * down[starts]
        return mix(h + (ends - starts).astype(np.uint64))


class RunHasher:
    """Hashes of runs of consecutive words from the word hashes of a chunk."""

    def __init__(self, word_hashes: np.ndarray):
        self.up, self.down = _RUN_POW.get(len(word_hashes) + 1)
        self.total = np.zeros(len(word_hashes) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(word_hashes * self.up[:len(word_hashes)], out=self.total[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[ends] - self.total[starts]) * self.down[starts]
                       + (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def run_starts(words: Words, k: int) -> np.ndarray:
    """Word indices at which k consecutive words of one row start."""
    if not len(words):
        return np.zeros(0, np.int64)
    left = np.repeat(words.row_off[1:], words.counts) - np.arange(len(words))
    return np.flatnonzero(left >= k)


def list_column(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


def map_chunks(df: DataFrame, schema: str, fn: Callable[[Chunk], pa.RecordBatch | None], text: str = "text",
               setup: Callable | None = None) -> DataFrame:
    """Arrow map over chunks of rows of ``df``.  ``setup`` builds per-task
    state, handed to ``fn`` as its second argument; its ``release``, if it has one, is called
    at the end of the task."""

    def run(batches):
        state = setup() if setup is not None else None
        try:
            for batch in batches:
                for chunk in chunks(batch, text):
                    out = fn(chunk, state) if setup is not None else fn(chunk)
                    if out is not None:
                        yield out
        finally:
            if hasattr(state, "release"):
                state.release()

    return df.mapInArrow(run, schema)


class HashIndex:
    """Open-addressing map from 64-bit keys to row numbers, looked up for whole
    arrays (the keys come from a bounded model, not from the corpus)."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.asarray(keys, np.uint64)
        size = 1 << max(4, int(np.ceil(np.log2(max(len(self.keys), 1) * 4))))
        self.mask = U64(size - 1)
        self.slot = np.full(size, -1, np.int64)
        self.depth = 0
        todo = np.arange(len(self.keys))
        while len(todo):
            at = ((self.keys[todo] + U64(self.depth)) & self.mask).astype(np.int64)
            free = self.slot[at] < 0
            cand, pos = todo[free], at[free]
            self.slot[pos] = cand
            won = self.slot[pos] == cand
            todo = np.concatenate([todo[~free], cand[~won]])
            self.depth += 1

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 where absent."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.keys):
            return out
        todo = np.arange(len(h))
        for d in range(self.depth):
            s = self.slot[((h[todo] + U64(d)) & self.mask).astype(np.int64)]
            hit = s >= 0
            ok = np.zeros(len(todo), bool)
            ok[hit] = self.keys[s[hit]] == h[todo[hit]]
            out[todo[ok]] = s[ok]
            todo = todo[hit & ~ok]
            if not len(todo):
                break
        return out
