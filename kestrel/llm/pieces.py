"""SentencePiece encoding with source offsets, and decoding.

A text is normalised by longest-prefix replacement through the model's compiled
character map; every normalised byte remembers the source byte it came from.
Merges then run on slices that no piece can cross (see ``pairmerge``), characters
without a piece fall back to byte pieces, and each piece is projected through the
alignment to the span of original bytes it stands for."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kestrel.llm.bpe import all_splits, codepoints, loaded
from kestrel.llm.pairmerge import BytePool, SliceCache, binary_parts, merge_all
from kestrel.llm.textkit import Chunk, list_column, map_chunks

MARK = "▁".encode()
UNKNOWN_SURFACE = " ⁇ ".encode()
# Piece kinds in model files.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6


@dataclass(frozen=True)
class Model:
    """What the tasks need of a model file; its size does not depend on the data."""
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    charsmap: bytes
    dummy_prefix: bool
    trim_spaces: bool


def read_model(path: str) -> Model:
    """Reads a BPE model with byte fallback (other kinds of model: ValueError)."""
    from sentencepiece import sentencepiece_model_pb2
    m = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    kinds = tuple(p.type for p in m.pieces)
    if m.trainer_spec.model_type != 2 or not m.trainer_spec.byte_fallback or m.trainer_spec.treat_whitespace_as_suffix \
            or not m.normalizer_spec.escape_whitespaces or not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("only BPE models with byte fallback and without symbols of the user's are supported")
    return Model(tuple(p.piece for p in m.pieces), tuple(p.score for p in m.pieces), kinds,
                 m.normalizer_spec.precompiled_charsmap, m.normalizer_spec.add_dummy_prefix,
                 m.normalizer_spec.remove_extra_whitespaces)


class CharMap:
    """The compiled map: a double-array trie over UTF-8 and a pool of replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4")
        pool = blob[4 + size:]
        self.pool = np.frombuffer(pool, np.uint8)
        ends = np.flatnonzero(self.pool == 0)
        self.pool_end = ends[np.searchsorted(ends, np.arange(len(self.pool)))] if len(ends) else ends

    @staticmethod
    def _jump(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: np.ndarray, at: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes matched or 0, place of the replacement) of the longest entry that
        starts at each position and ends by its ``limit``; all walk the trie together."""
        matched, value = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        if not len(self.units):
            return matched, value
        who = np.arange(len(at))
        node = np.full(len(at), int(self._jump(self.units[0])), np.int64)
        step = 0
        while len(who):
            inside = at[who] + step < limit[who]
            who, node = who[inside], node[inside]
            byte = data[at[who] + step].astype(np.int64)
            node = node ^ byte
            ok = node < len(self.units)
            who, node, byte = who[ok], node[ok], byte[ok]
            unit = self.units[node].astype(np.int64)
            ok = (unit & 0x800000FF) == byte
            who, node, unit = who[ok], node[ok], unit[ok]
            node = node ^ self._jump(unit)
            step += 1
            leaf = (unit >> 8 & 1).astype(bool)
            matched[who[leaf]] = step
            value[who[leaf]] = self.units[node[leaf]] & 0x7FFFFFFF
        return matched, value


class Normalised:
    """``data``/``offsets`` of the normalised rows; ``source[i]`` is the original
    byte (in the buffer) behind normalised byte i, ``row_end`` the source end of each row."""

    def __init__(self, data, offsets, source, row_end):
        self.data, self.offsets, self.source, self.row_end = data, offsets, source, row_end


def normalise(data: np.ndarray, offsets: np.ndarray, chars: CharMap, dummy_prefix: bool, trim: bool) -> Normalised:
    """Longest-prefix normalisation of all rows of a buffer (valid UTF-8)."""
    row_end = offsets[1:].copy()
    if len(chars.units) and len(data):
        text, source = _replace(data, offsets, chars)
    else:
        text, source = data, np.arange(len(data), dtype=np.int32 if len(data) < 2 ** 31 else np.int64)
    bounds = np.searchsorted(source, offsets)
    if trim and len(text):
        keep = _single_spaces(text, source, bounds, row_end)
        upto = np.concatenate([[0], np.cumsum(keep)])
        text, source, bounds = text[keep], source[keep], upto[bounds]
    # a space becomes the three bytes of the mark; one more mark opens a row
    spaces, opened = np.flatnonzero(text == 0x20), bounds[:-1][np.diff(bounds) > 0]
    copies = np.ones(len(text), np.int32)
    copies[spaces] = len(MARK)
    if dummy_prefix:
        copies[opened] += len(MARK)
    upto = np.concatenate([[0], np.cumsum(copies, dtype=np.int64)])
    out = np.repeat(text, copies)
    marks = upto[spaces + 1] - len(MARK)
    if dummy_prefix:
        marks = np.concatenate([marks, upto[opened]])
    for k, b in enumerate(MARK):
        out[marks + k] = b
    return Normalised(out, upto[bounds], np.repeat(source, copies), row_end)


def _single_spaces(text: np.ndarray, source: np.ndarray, bounds: np.ndarray, row_end: np.ndarray) -> np.ndarray:
    """What stays when spaces at row starts and ends and all but the first of a run go;
    literal marks at a row's end go with the spaces.  Moves ``row_end`` back accordingly."""
    space = text == 0x20
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    before = np.ones(len(text), bool)
    before[1:] = space[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = True
    last = np.full(len(bounds) - 1, -1)
    solid = np.flatnonzero(~(space | _mark_bytes(text)))
    last[row[solid]] = solid
    gone = np.flatnonzero(np.arange(len(text)) > last[row])
    rows, first = np.unique(row[gone], return_index=True)
    row_end[rows] = source[gone[first]]
    keep = ~(space & before)
    keep[gone] = False
    return keep


def _mark_bytes(data: np.ndarray) -> np.ndarray:
    """Bytes of literal space marks."""
    inside = np.zeros(len(data), bool)
    if len(data) > 2:
        first = np.flatnonzero((data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2]))
        for k in range(3):
            inside[first + k] = True
    return inside


def _replace(data: np.ndarray, offsets: np.ndarray, chars: CharMap) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(at, len(data)))
    limit = offsets[np.searchsorted(offsets, at, "right")]
    matched, value = chars.longest(data, at, limit)
    wide = np.flatnonzero(matched > size)
    if len(wide):  # what a longer entry covers starts nothing of its own
        covered, until = np.zeros(len(at), bool), -1
        for i in wide.tolist():
            if at[i] >= until:
                until = int(at[i] + matched[i])
                covered[i + 1:np.searchsorted(at, until)] = True
        at, size, matched, value = (x[~covered] for x in (at, size, matched, value))
    hit = matched > 0
    start = np.where(hit, value + len(data), at)
    length = size.copy()
    length[hit] = chars.pool_end[value[hit]] - value[hit]
    both = np.concatenate([data, chars.pool])
    upto = np.cumsum(length) - length
    take = np.repeat(start - upto, length) + np.arange(int(length.sum()))
    return both[take], np.repeat(at, length)


class PieceCodec:
    def __init__(self, model: Model):
        self.model, self.size = model, len(model.pieces)
        self.chars = CharMap(model.charsmap)
        normal = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == NORMAL}
        symbols = dict(normal)
        symbols.update({c: self.size + ord(c) for p in normal for c in p if c not in normal})
        order = {s: r for r, s in enumerate(sorted({model.scores[i] for i in normal.values()}, reverse=True))}
        self.pairs = all_splits(symbols, {p: order[model.scores[i]] for p, i in normal.items() if len(p) > 1})
        self.symbol = np.arange(self.size, self.size + 0x110000, dtype=np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.byte_id = np.zeros(256, np.int32)
        for i, k in enumerate(model.kinds):
            if k == BYTE:
                self.byte_id[int(model.pieces[i][3:-1], 16)] = i
        mark = MARK.decode()
        self.mark_inside = any(b == mark and a != mark for p in normal for a, b in zip(p, p[1:]))
        self.alone = np.ones(256, bool)       # ASCII that no longer piece holds
        self.alone[128:] = False
        self.alone[[ord(c) for p in normal if len(p) > 1 for c in p if ord(c) < 128]] = False
        self.surface = [self._surface(i) for i in range(self.size)]
        self.is_normal = np.array([k == NORMAL for k in model.kinds])
        self.is_control = np.array([k == CONTROL for k in model.kinds])
        self.controls = {i for i, k in enumerate(model.kinds) if k == CONTROL}
        self.surfaces = BytePool(self.surface)
        self.decimals = BytePool([b",%d" % i for i in range(self.size)])
        self.is_byte = np.array([k == BYTE for k in model.kinds])
        #: bytes of the normalised text behind an id; a byte piece stands for one byte
        self.lengths = np.array([1 if k == BYTE else len(p.encode()) for p, k in zip(model.pieces, model.kinds)], np.int64)
        self.cache = SliceCache(self._encode_slices)

    def _surface(self, i: int) -> bytes:
        kind, piece = self.model.kinds[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:-1], 16)])
        return {CONTROL: b"", UNKNOWN: UNKNOWN_SURFACE}.get(kind, piece.encode().replace(MARK, b" "))

    def _encode_slices(self, values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        data, off = binary_parts(values)
        cp, at = codepoints(data)
        flat, counts = merge_all(self.pairs, self.symbol[cp], np.diff(np.searchsorted(at, off)))
        odd = flat >= self.size
        if odd.any():
            found, which = np.unique(flat[odd] - self.size, return_inverse=True)
            coded = [chr(c).encode() for c in found.tolist()]
            sizes = np.ones(len(flat), np.int64)
            sizes[odd] = np.array([len(x) for x in coded])[which]
            wide = np.repeat(flat, sizes)
            wide[np.repeat(odd, sizes)] = self.byte_id[np.frombuffer(b"".join([coded[i] for i in which.tolist()]), np.uint8)]
            counts = np.add.reduceat(np.append(sizes, 0), np.cumsum(counts) - counts) * (counts > 0)
            flat = wide
        return flat, counts

    def normalise(self, data: np.ndarray, offsets: np.ndarray) -> Normalised:
        return normalise(data, offsets, self.chars, self.model.dummy_prefix, self.model.trim_spaces)

    def slice_starts(self, norm: Normalised) -> np.ndarray:
        """Places that no merge can cross: rows, ASCII that is in no longer piece, and
        a space mark behind another character (where no piece holds that)."""
        d = norm.data
        first = np.zeros(len(d) + 1, bool)
        first[norm.offsets] = True
        if not self.mark_inside and len(d) > 2:
            mark = (d[:-2] == MARK[0]) & (d[1:-1] == MARK[1]) & (d[2:] == MARK[2])
            fresh = mark.copy()
            fresh[3:] &= ~mark[:-3]
            first[:-3] |= fresh
        alone = self.alone[d]
        first[:-1] |= alone
        first[1:] |= alone
        return np.flatnonzero(first[:-1])

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """(ids, first id of each row: n+1 entries, span starts, span ends): spans in
        bytes of the buffer; of a character's byte pieces the last one has its span,
        those before it are empty."""
        norm = self.normalise(data, offsets)
        starts = self.slice_starts(norm)
        ids, sizes = self.cache(norm.data, starts)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        row = upto[np.searchsorted(starts, norm.offsets)]
        end = np.cumsum(self.lengths[ids])
        begin = end - self.lengths[ids]
        # source of the normalised byte behind the token; at a row's end that of the row
        behind = np.append(norm.source, 0)[end]
        full = np.diff(row) > 0
        behind[row[1:][full] - 1] = norm.row_end[full]
        span = norm.source[begin]
        if self.is_byte[ids].any():
            tail = np.append(norm.data, 0)[end] & 0xC0 == 0x80   # further bytes of the same character follow
            lead = np.flatnonzero((norm.data & 0xC0) != 0x80)
            some = self.is_byte[ids]
            span[some] = norm.source[lead[np.searchsorted(lead, begin[some], "right") - 1]]
            behind = np.where(some & tail, span, behind)
        return ids, row, span, behind

    def release(self) -> None:
        self.cache.clear()

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text; byte pieces that form no character give U+FFFD each."""
        kinds, prefix = self.model.kinds, self.model.dummy_prefix or self.model.trim_spaces
        parts = list(map(self.surface.__getitem__, ids))
        if prefix:
            for j, i in enumerate(ids):
                if kinds[i] == CONTROL:
                    continue
                if kinds[i] == NORMAL and parts[j][:1] == b" ":
                    parts[j] = parts[j][1:]
                    if self.model.trim_spaces and not parts[j]:
                        continue
                break
        out = b"".join(parts)
        try:
            out.decode()
            if self.controls.isdisjoint(ids):
                return out
        except UnicodeDecodeError:
            pass
        return self._decode_runs(ids, parts)

    def decode_rows(self, ids: np.ndarray, row: np.ndarray) -> list[bytes]:
        """``decode`` for all rows of a buffer at once."""
        raw, off = self.surfaces.joined(ids)
        cuts, ends = off[row].tolist(), row.tolist()
        plain = not self.is_control[ids].any() and _is_text(raw)
        out = []
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            part = bytes(raw[a:b])
            if plain and not (self.model.trim_spaces and part[:2] == b"  "):
                first = part[:1] == b" " and (self.model.dummy_prefix or self.model.trim_spaces) and self.is_normal[ids[ends[i]]]
                out.append(part[1:] if first else part)
            else:
                out.append(self.decode(ids[ends[i]:ends[i + 1]].tolist()))
        return out

    def _decode_runs(self, ids: list[int], parts: list[bytes]) -> bytes:
        out, run = [], b""
        for i, part in zip([*ids, -1], [*parts, b""]):
            if i >= 0 and self.is_byte[i]:
                run += part
                continue
            while run:
                size = next((k for k in range(1, 5) if _is_character(run[:k])), 0)
                out.append(run[:size] if size else "�".encode())
                run = run[size or 1:]
            out.append(part)
        return b"".join(out)


def _is_text(raw: memoryview) -> bool:
    try:
        str(raw, "utf-8")
        return True
    except UnicodeDecodeError:
        return False


def _is_character(b: bytes) -> bool:
    try:
        return len(b.decode()) == 1
    except UnicodeDecodeError:
        return False


def _codec(spark, path: str):
    shared = spark.sparkContext.broadcast(read_model(path))
    return lambda: loaded(PieceCodec, shared.value)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids, starts, ends): piece ids of each whole text and the original bytes
    each piece stands for.  Null and empty texts have empty lists; repeated rows are
    encoded each; an empty table gives no rows; other columns are not read."""

    def one(chunk: Chunk, codec: PieceCodec):
        ids, row, begin, end = codec.encode(chunk.data, chunk.offsets)
        counts = np.diff(row)
        base = np.repeat(chunk.offsets[:-1], counts)
        return pa.RecordBatch.from_arrays(
            [chunk.column(id_col), *(list_column(x.astype(np.int32), counts, pa.int32()) for x in (ids, begin - base, end - base))],
            names=[id_col, "ids", "starts", "ends"])

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema[id_col], *(T.StructField(c, ints) for c in ("ids", "starts", "ends"))])
    return map_chunks(docs.select(id_col, text), schema, one, text, _codec(docs.sparkSession, path))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, text) of each id list (null list: empty text)."""
    setup = _codec(encoded.sparkSession, path)

    def run(batches):
        codec = setup()
        for b in batches:
            lists = b.column(b.schema.get_field_index(ids)).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(id_col)),
                                              pa.array([codec.decode(x or []).decode() for x in lists], pa.string())],
                                             names=[id_col, "text"])

    schema = T.StructType([encoded.schema[id_col], T.StructField("text", T.StringType())])
    return encoded.select(id_col, ids).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, n_covered): encodes each whole
    text, then decodes its ids.  ids_sha256 is over the decimal ids joined by commas;
    n_covered counts the original bytes that some piece stands for.  Null and empty
    texts: no tokens, digests of nothing; rows are kept one for one."""

    def one(chunk: Chunk, codec: PieceCodec):
        ids, row, begin, end = codec.encode(chunk.data, chunk.offsets)
        raw, off = codec.decimals.joined(ids)
        cuts = off[row].tolist()
        joined = [hashlib.sha256(raw[a + 1:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:])]
        decoded = [hashlib.sha256(t).hexdigest() for t in codec.decode_rows(ids, row)]
        covered = np.concatenate([[0], np.cumsum(end - begin)])
        return pa.RecordBatch.from_arrays(
            [chunk.column(id_col), pa.array(np.diff(row), pa.int64()), pa.array(joined, pa.string()),
             pa.array(decoded, pa.string()), pa.array(covered[row[1:]] - covered[row[:-1]], pa.int64())],
            names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "n_covered"])

    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType()), T.StructField("n_covered", T.LongType())])
    return map_chunks(docs.select(id_col, text), schema, one, text, _codec(docs.sparkSession, path))
