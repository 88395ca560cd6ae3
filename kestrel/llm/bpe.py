"""Byte-level BPE with vectorised pre-tokenisation.

Codepoints are decoded in bulk and classed by table (letter, number, other,
white space, apostrophe with its contraction).  A finite-state transducer says
where a pre-token starts; because transition functions compose associatively,
all blocks of a text buffer are scanned side by side: first each block's
composed function, then the state each block starts in, then the states inside
the blocks.  No regular expression is involved.  The resulting byte slices feed
a pair merger with a cache; token byte offsets are kept, so ids decode exactly.

The transducer realises the pattern of the public byte-level tokenizers:
contractions, then optional-space letter / number / other runs, then white
space without its last character before a word."""

from __future__ import annotations

import base64
import hashlib
import json
import sys
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kestrel.llm.pairmerge import BytePool, PairTable, SliceCache, binary_parts, merge_all
from kestrel.llm.textkit import Chunk, list_column, map_chunks

_BLOCK = 256

# ---- codepoint classes -------------------------------------------------
LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
# The White_Space property of Unicode.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


UNSEEN = 255
_CLASSES = np.full(sys.maxunicode + 1, UNSEEN, np.uint8)
_CLASSES[WHITE_SPACE] = WHITE
_CLASSES[0x20] = SPACE


def codepoint_classes(cp: np.ndarray) -> np.ndarray:
    """Class of each codepoint; the table fills with the codepoints met."""
    kinds = _CLASSES[cp]
    unseen = kinds == UNSEEN
    if unseen.any():
        new = np.unique(cp[unseen])
        major = {"L": LETTER, "N": NUMBER}
        _CLASSES[new] = [major.get(unicodedata.category(chr(c))[0], OTHER) for c in new.tolist()]
        kinds = _CLASSES[cp]
    return kinds


# ---- transducer --------------------------------------------------------
# symbols: what is read, with the look-ahead of white space and contractions resolved
(S_LETTER, S_NUMBER, S_OTHER, S_LAST_SPACE, S_LAST_WHITE, S_MORE_WHITE, S_APOS1, S_APOS2) = range(8)
_RESET = 8  # added to a symbol that opens a row
# states: what the character just read belongs to
(Q_FRESH, Q_LETTER, Q_NUMBER, Q_OTHER, Q_SPACE, Q_WHITE, Q_NEED1, Q_NEED2) = range(8)


def _transducer() -> tuple[np.ndarray, np.ndarray]:
    """next[symbol, state], starts[symbol, state]."""
    nxt, new = np.zeros((16, 8), np.uint8), np.ones((16, 8), bool)
    for q in range(8):
        for s, own in ((S_LETTER, Q_LETTER), (S_NUMBER, Q_NUMBER), (S_OTHER, Q_OTHER)):
            nxt[s, q], new[s, q] = own, q not in (own, Q_SPACE)
        for s, need in ((S_APOS1, Q_NEED1), (S_APOS2, Q_NEED2)):
            joins = q in (Q_OTHER, Q_SPACE)  # inside a run of others the apostrophe is an ordinary one
            nxt[s, q], new[s, q] = (Q_OTHER, False) if joins else (need, True)
        nxt[S_LAST_SPACE, q], nxt[S_LAST_WHITE, q] = Q_SPACE, Q_FRESH
        nxt[S_MORE_WHITE, q], new[S_MORE_WHITE, q] = Q_WHITE, q != Q_WHITE
    nxt[S_LETTER, Q_NEED1], new[S_LETTER, Q_NEED1] = Q_FRESH, False
    nxt[S_LETTER, Q_NEED2], new[S_LETTER, Q_NEED2] = Q_NEED1, False
    nxt[_RESET:], new[_RESET:] = nxt[:8, :1], new[:8, :1]
    return nxt, new


_NEXT, _NEW = _transducer()


def scan_states(symbols: np.ndarray) -> np.ndarray:
    """State before each symbol, by composing transition functions over blocks."""
    n = len(symbols)
    blocks = -(-n // _BLOCK)
    grid = np.zeros(blocks * _BLOCK, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(blocks, _BLOCK).T)
    flat = _NEXT.reshape(-1)
    whole = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for column in grid:
        whole = flat[(column.astype(np.int16) << 3)[:, None] + whole]
    first = np.zeros(blocks, np.uint8)
    state = Q_FRESH
    for i, f in enumerate(whole.tolist()):
        first[i] = state
        state = f[state]
    before = np.empty_like(grid)
    now = first
    for i, column in enumerate(grid):
        before[i] = now
        now = flat[(column.astype(np.int16) << 3) + now]
    return before.T.reshape(-1)[:n]


def codepoints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codepoint, byte position) of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.uint32)
    cp = lead.copy()
    for low, high, size, keep in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0x100, 4, 0x07)):
        some = np.flatnonzero((lead >= low) & (lead < high))
        if len(some):
            v = lead[some] & keep
            for k in range(1, size):
                v = v << 6 | data[at[some] + k] & 0x3F
            cp[some] = v
    return cp, at


def pretoken_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which pre-tokens start, for all rows of a buffer."""
    if not len(data):
        return np.zeros(0, np.int64)
    cp, at = codepoints(data)
    n = len(cp)
    kind = codepoint_classes(cp)
    row_start = np.zeros(n + 1, bool)
    row_start[np.searchsorted(at, offsets)] = True  # also one behind the last
    symbol = np.array([S_LETTER, S_NUMBER, S_OTHER, S_LAST_SPACE, S_LAST_WHITE], np.uint8)[kind]
    white = kind >= SPACE
    ends = row_start[1:].copy()
    more = white.copy()
    more[:-1] &= white[1:] | ends[:-1]
    symbol[more] = S_MORE_WHITE
    apos = np.flatnonzero(cp == 0x27)
    if len(apos):
        def ahead(k):
            i = np.minimum(apos + k, n - 1)
            same = apos + k < n
            for j in range(1, k + 1):
                same &= ~row_start[np.minimum(apos + j, n)]
            return np.where(same, cp[i], 0)
        a, b = ahead(1), ahead(2)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        symbol[apos[one]], symbol[apos[two]] = S_APOS1, S_APOS2
    symbol[row_start[:-1]] += _RESET
    return at[_NEW[symbol, scan_states(symbol)]]


# ---- merging -----------------------------------------------------------
def load_ranks(raw: bytes) -> dict[bytes, int]:
    """token bytes -> rank from the lines ``base64 rank``."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


def all_splits(symbols: dict, ranked: dict) -> PairTable:
    """Every way to split a ranked symbol into two symbols; for vocabularies that
    rank the joined symbol."""
    left, right, rank, merged = (array("i") for _ in range(4))
    for p, r in ranked.items():
        for i in range(1, len(p)):
            a, b = symbols.get(p[:i]), symbols.get(p[i:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                rank.append(r)
                merged.append(symbols[p])
    return PairTable(left, right, rank, merged)


class Codec:
    """Byte-level vocabulary.  ``whole`` holds slices that are tokens as they stand
    (None: only merges decide)."""

    def __init__(self, ids: dict[bytes, int], pairs: PairTable, whole: dict[bytes, int] | None):
        self.whole, self.pairs = whole, pairs
        self.first = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        self.pieces = [b""] * (max(ids.values()) + 1)
        for k, v in ids.items():
            self.pieces[v] = k
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.pool = BytePool(self.pieces)
        self.cache = SliceCache(self._encode_slices)

    @classmethod
    def from_ranks(cls, raw: bytes) -> Codec:
        ranks = load_ranks(raw)
        return cls(ranks, all_splits(ranks, ranks), ranks)

    @classmethod
    def from_json(cls, raw: bytes) -> Codec:
        """Vocabulary and merge list of a byte-level tokenizer file; characters stand for bytes."""
        model = json.loads(raw)["model"]
        byte = byte_of_char()
        ids = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if all(c in byte for c in t)}
        named = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = PairTable([named[a] for a, _ in merges], [named[b] for _, b in merges], range(len(merges)),
                          [named[a + b] for a, b in merges])
        return cls(ids, pairs, None)

    def _encode_slices(self, values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        data, off = binary_parts(values)
        sizes = np.diff(off)
        if self.whole is None:
            return merge_all(self.pairs, self.first[data], sizes)
        token = np.fromiter(map(self.whole.get, values.to_pylist(), [-1] * len(values)), np.int64, len(values))
        rest = np.flatnonzero(token < 0)
        split, split_sizes = merge_all(self.pairs, self.first[data[np.repeat(token < 0, sizes)]], sizes[rest])
        counts = np.ones(len(values), np.int64)
        counts[rest] = split_sizes
        flat = np.repeat(token, counts).astype(np.int32)
        flat[flat < 0] = split
        return flat, counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, first id of each row: n+1 entries)."""
        starts = pretoken_starts(data, offsets)
        ids, sizes = self.cache(data, starts)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return ids, upto[np.searchsorted(starts, offsets)]

    def release(self) -> None:
        self.cache.clear()

    def decode(self, ids: np.ndarray) -> bytes:
        return bytes(self.pool.joined(ids)[0])


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes in tokenizer files: printable Latin-1 bytes
    stand for themselves, the others for the code points from 256 in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> bytes:
    """The rank file, read on the driver and sent to the tasks (one vocabulary:
    its size does not depend on the data)."""
    with open(path, "rb") as f:
        return f.read()


_LOADED: dict = {}


def loaded(make: Callable[[bytes], object], raw: bytes):
    """One codec, with its cache, per vocabulary and worker process."""
    key = (make, hash(raw))
    if key not in _LOADED:
        _LOADED[key] = make(raw)
    return _LOADED[key]


def _codec(spark, path: str):
    shared = spark.sparkContext.broadcast(read_vocabulary(path))
    return lambda: loaded(Codec.from_ranks, shared.value)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids array<int>, offsets array<int>): ids of each whole text and the
    byte at which each token starts.  Null and empty texts have empty lists;
    repeated rows are encoded each; other columns are not read."""

    def one(chunk: Chunk, codec: Codec):
        ids, row = codec.encode(chunk.data, chunk.offsets)
        size = codec.lengths[ids]
        start = np.cumsum(size) - size
        start -= np.repeat(chunk.offsets[:-1], np.diff(row))
        counts = np.diff(row)
        return pa.RecordBatch.from_arrays([chunk.column(id_col), list_column(ids.astype(np.int32), counts, pa.int32()),
                                           list_column(start, counts, pa.int32())], names=[id_col, "ids", "offsets"])

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", ints), T.StructField("offsets", ints)])
    return map_chunks(docs.select(id_col, text), schema, one, text, _codec(docs.sparkSession, path))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, data binary): bytes of each id list (null list: empty)."""
    setup = _codec(encoded.sparkSession, path)

    def run(batches):
        codec = setup()
        for b in batches:
            lists = b.column(b.schema.get_field_index(ids)).to_pylist()
            data = [codec.decode(np.array(x or [], np.int64)) for x in lists]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(id_col)), pa.array(data, pa.binary())],
                                             names=[id_col, "data"])

    schema = T.StructType([encoded.schema[id_col], T.StructField("data", T.BinaryType())])
    return encoded.select(id_col, ids).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes each whole text, then
    decodes its ids.  ids_sha256 is over the ids as little-endian unsigned
    32-bit integers.  Null and empty texts: no tokens, digests of nothing."""

    def one(chunk: Chunk, codec: Codec):
        ids, row = codec.encode(chunk.data, chunk.offsets)
        little, cuts = memoryview(ids.astype("<u4")).cast("B"), (row * 4).tolist()
        raw, off = codec.pool.joined(ids)
        ends = off[row].tolist()
        return pa.RecordBatch.from_arrays(
            [chunk.column(id_col), pa.array(np.diff(row), pa.int64()),
             pa.array([hashlib.sha256(little[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:])], pa.string()),
             pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])], pa.string())],
            names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return map_chunks(docs.select(id_col, text), schema, one, text, _codec(docs.sparkSession, path))
