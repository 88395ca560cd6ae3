"""Alignment of two tokenizers over the same bytes.

Both tokenisations of a text tile the same bytes, so the token that covers a
byte is the last one that starts at or before it.  ``pandas.merge_asof``, keyed by
document, looks up that token for every token start in the other side; the union
of both directions holds each overlapping pair of tokens once.  Byte offsets at
which tokens of both sides end cut a text into groups.

Counts of linked id pairs are taken over the whole corpus: chunks of documents
give distinct pairs with document counts, which Spark sums.  The most frequent
pairs (at most ``FREQUENT``, whatever the corpus) are sent to the tasks; links to all
others meet their counts in a join, which therefore has no hot keys."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kestrel.llm.bpe import Codec, loaded, read_vocabulary
from kestrel.llm.pairmerge import BytePool
from kestrel.llm.pieces import MARK, PieceCodec, read_model
from kestrel.llm.scratch import stored
from kestrel.llm.textkit import Chunk, HashIndex, chunks, column_bytes, map_chunks, mix
from kestrel.session import cut_lineage

#: pairs held by every task; a bound of memory, not of the result
FREQUENT = 1 << 19
_STEPS = 8  # classes of counts for each doubling
DIGESTS = ("n_a", "n_b", "n_groups", "n_links")


class Side:
    """Token bytes and written ids of one tokenizer; ``written`` has them behind each separator."""

    def __init__(self, token_bytes: list[bytes]):
        self.size = len(token_bytes)
        self.pool = BytePool(token_bytes)
        self.lengths = np.array([len(t) for t in token_bytes], np.int64)

    def written(self, separators: bytes) -> list[bytes]:
        return [bytes([s]) + b"%d" % i for s in separators for i in range(self.size)]


class Aligner:
    def __init__(self, a: Codec, b: PieceCodec):
        self.a, self.b = a, b
        self.side_a = Side(a.pieces)
        self.side_b = Side([bytes([int(p[3:-1], 16)]) if one else p.encode().replace(MARK, b" ")
                            for p, one in zip(b.model.pieces, b.is_byte.tolist())])
        self.written = BytePool(self.side_a.written(b",;") + self.side_b.written(b",|"))
        self.width = self.side_b.size  # pair code = a * width + b
        if self.side_a.size * self.width >= 1 << 32:
            raise ValueError("pair codes take 32 bits")
        # without replacements only the length can differ (a literal mark takes three bytes, its token one)
        self.lengths_decide = not len(b.chars.units) and b.model.dummy_prefix and not b.model.trim_spaces

    def tokens(self, data: np.ndarray, offsets: np.ndarray):
        """(ids a, row offsets a, ids b, row offsets b): rows that are empty or whose
        joined tokens are not the space and the text have none."""
        size = np.diff(offsets)
        full = size > 0
        spaced = np.insert(data, offsets[:-1][full], 0x20)
        bounds = np.concatenate([[0], np.cumsum(size + full)])
        ids_a, row_a = self.a.encode(spaced, bounds)
        ids_b, row_b, _, _ = self.b.encode(data, offsets)
        good = full.copy()
        for side, ids, row in ((self.side_a, ids_a, row_a), (self.side_b, ids_b, row_b)):
            got = np.diff(np.concatenate([[0], np.cumsum(side.lengths[ids])])[row])
            fits = got == size + full
            if not self.lengths_decide:
                joined = np.frombuffer(side.pool.joined(ids)[0], np.uint8)[np.repeat(fits, got)]
                wrong = np.flatnonzero(joined != spaced[np.repeat(fits, size + full)])
                fits[np.repeat(np.arange(len(size)), np.where(fits, size + full, 0))[wrong]] = False
            good &= fits
        return *_keep(ids_a, row_a, good), *_keep(ids_b, row_b, good)

    def release(self) -> None:
        self.a.release()
        self.b.release()

    def align(self, data: np.ndarray, offsets: np.ndarray) -> Aligned:
        return Aligned(self, *self.tokens(data, offsets))


def _keep(ids: np.ndarray, row: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(row)
    if not good.all():
        ids = ids[np.repeat(good, counts)]
    return ids, np.concatenate([[0], np.cumsum(np.where(good, counts, 0))])


class Aligned:
    """Links and groups of a chunk: ``link_a``/``link_b`` token numbers, ``group_a``/
    ``group_b`` the group of each token, ``n_groups`` per row."""

    def __init__(self, aligner: Aligner, ids_a, row_a, ids_b, row_b):
        self.aligner, self.ids_a, self.row_a, self.ids_b, self.row_b = aligner, ids_a, row_a, ids_b, row_b
        n = len(row_a) - 1
        end_a, end_b = np.cumsum(aligner.side_a.lengths[ids_a]), np.cumsum(aligner.side_b.lengths[ids_b])
        start_a, start_b = end_a - aligner.side_a.lengths[ids_a], end_b - aligner.side_b.lengths[ids_b]
        self.doc_a, doc_b = np.repeat(np.arange(n), np.diff(row_a)), np.repeat(np.arange(n), np.diff(row_b))
        a = pd.DataFrame({"at": start_a, "doc": self.doc_a, "a": np.arange(len(ids_a))})
        b = pd.DataFrame({"at": start_b, "doc": doc_b, "b": np.arange(len(ids_b))})
        covering_b = pd.merge_asof(a, b, on="at", by="doc")["b"].to_numpy(np.int64)
        covering_a = pd.merge_asof(b, a, on="at", by="doc")["a"].to_numpy(np.int64)
        later = np.flatnonzero(start_a[covering_a] != start_b)  # equal starts came from the first direction
        self.link_a = np.concatenate([np.arange(len(ids_a)), covering_a[later]])
        self.link_b = np.concatenate([covering_b, later])
        ends = np.zeros((2, int(end_a[-1]) + 1 if len(end_a) else 1), bool)
        ends[0, end_a], ends[1, end_b] = True, True
        both_a, both_b = ends[1, end_a], ends[0, end_b]
        self.opens_a, self.opens_b = np.concatenate([[True], both_a[:-1]]), np.concatenate([[True], both_b[:-1]])
        self.group_a, self.group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
        upto = np.concatenate([[0], np.cumsum(both_a)])
        self.groups, self.n_groups = int(upto[-1]), np.diff(upto[row_a])

    def texts(self) -> list[memoryview | None]:
        """``a1,a2|b1;a3|b2,b3`` per row; None without tokens."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        per_a = np.concatenate([[0], np.cumsum(np.bincount(self.group_a, minlength=self.groups))])
        per_b = np.concatenate([[0], np.cumsum(np.bincount(self.group_b, minlength=self.groups))])
        size_a, size_b = self.aligner.side_a.size, self.aligner.side_b.size
        parts = np.empty(n_a + n_b, np.int32)
        parts[np.arange(n_a) + per_b[self.group_a]] = self.ids_a + size_a * self.opens_a[:n_a]
        parts[np.arange(n_b) + per_a[self.group_b + 1]] = self.ids_b + size_b * self.opens_b[:n_b] + 2 * size_a
        raw, off = self.aligner.written.joined(parts)
        cuts = off[self.row_a + self.row_b].tolist()
        return [raw[x + 1:y] if y > x else None for x, y in zip(cuts[:-1], cuts[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, pair code, links) of the distinct linked id pairs of each row, sorted."""
        code = self.ids_a[self.link_a].astype(np.int64) * self.aligner.width + self.ids_b[self.link_b]
        key = np.sort(self.doc_a[self.link_a] << 32 | code)
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        return key[at] >> 32, key[at] & 0xFFFFFFFF, np.diff(np.append(at, len(key)))


def _aligner(spark, path_a: str, path_b: str):
    shared = spark.sparkContext.broadcast((read_vocabulary(path_a), read_model(path_b)))

    def build(files):
        return Aligner(loaded(Codec.from_json, files[0]), loaded(PieceCodec, files[1]))
    return lambda: loaded(_Build(build), shared.value)


class _Build:
    """A constructor with an identity of its own, for ``loaded``."""

    def __init__(self, make):
        self.make = make

    def __call__(self, raw):
        return self.make(raw)

    def __hash__(self):
        return hash("aligner")

    def __eq__(self, other):
        return isinstance(other, _Build)


def spans(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, group, a_ids, b_ids): the groups of every text in order, as lists of ids."""
    def one(chunk: Chunk, aligner: Aligner):
        al = aligner.align(chunk.data, chunk.offsets)
        row = np.repeat(np.arange(chunk.n), al.n_groups)
        group = np.arange(al.groups) - np.repeat(np.cumsum(al.n_groups) - al.n_groups, al.n_groups)

        def lists(ids, groups):
            off = np.concatenate([[0], np.cumsum(np.bincount(groups, minlength=al.groups))]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(off), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([chunk.column(id_col).take(pa.array(row)), pa.array(group, pa.int64()),
                                           lists(al.ids_a, al.group_a), lists(al.ids_b, al.group_b)],
                                          names=[id_col, "group", "a_ids", "b_ids"])

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([docs.schema[id_col], T.StructField("group", T.LongType()), T.StructField("a_ids", ints), T.StructField("b_ids", ints)])
    return map_chunks(docs.select(id_col, text), schema, one, text, _aligner(docs.sparkSession, path_a, path_b))


def _schemas(id_type: T.DataType) -> tuple[T.StructType, T.StructType]:
    """Row schemas of the two passes: documents, and pair rows with only ``code`` and ``n``
    (and ``row`` in the second pass)."""
    shared = [T.StructField("row", T.LongType()), T.StructField("id", id_type), *(T.StructField(c, T.LongType()) for c in DIGESTS),
              T.StructField("groups_sha256", T.StringType())]
    pair = [T.StructField("code", T.LongType()), T.StructField("n", T.LongType())]
    return (T.StructType([*shared, T.StructField("codes", T.BinaryType()), T.StructField("links", T.BinaryType()), *pair]),
            T.StructType([*shared, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), *pair]))


def _batch(arrow: pa.Schema, columns: dict, n: int) -> pa.RecordBatch:
    """Columns that are not given are null."""
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow],
                                      schema=arrow)


def _blobs(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(flat)
    off = np.concatenate([[0], np.cumsum(counts * flat.itemsize)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(off), pa.py_buffer(flat)])


def _describe(docs: DataFrame, path_a: str, path_b: str, text: str) -> DataFrame:
    """Rows of documents (numbers, digest, their distinct pairs) and, apart from them,
    rows (code, n) with the pairs of each chunk and how many of its documents hold them."""
    schema = _schemas(docs.schema["id"].dataType)[0]
    arrow = to_arrow_schema(schema)

    def run(batches):
        aligner = setup()
        for chunk in (c for batch in batches for c in chunks(batch, text)):
            al = aligner.align(chunk.data, chunk.offsets)
            row, code, times = al.pairs()
            per_row = np.bincount(row, minlength=chunk.n)
            step = np.diff(code, prepend=0)
            first = np.cumsum(per_row) - per_row
            first = first[per_row > 0]
            step[first] = code[first]
            digests = [hashlib.sha256(t).hexdigest() if t is not None else "" for t in al.texts()]
            numbers = {"row": chunk.column("row"), "id": chunk.column("id"), "n_a": pa.array(np.diff(al.row_a)), "n_b": pa.array(np.diff(al.row_b)),
                       "n_groups": pa.array(al.n_groups), "n_links": pa.array(np.bincount(row, times, chunk.n).astype(np.int64)),
                       "groups_sha256": pa.array(digests, pa.string()), "codes": _blobs(step.astype("<u4"), per_row),
                       "links": _blobs(times.astype("<u4"), per_row)}
            yield _batch(arrow, numbers, chunk.n)
            distinct, n = np.unique(code, return_counts=True)
            yield _batch(arrow, {"code": pa.array(distinct), "n": pa.array(n.astype(np.int64))}, len(n))
        aligner.release()

    setup = _aligner(docs.sparkSession, path_a, path_b)
    return docs.select("row", "id", text).mapInArrow(run, schema)


def _pair_counts(described: DataFrame, width: int) -> DataFrame:
    """(code, n, best): documents that hold each linked pair; best marks the highest
    count of the pair's first id.  The table of highest counts has one row per id of
    the vocabulary at most."""
    counts = described.where(F.col("code").isNotNull()).groupBy("code").agg(F.sum("n").alias("n"))
    a = F.floor(F.col("code") / width)
    counts = cut_lineage(counts)
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    return counts.withColumn("a", a).join(F.broadcast(top), "a").select("code", "n", (F.col("n") == F.col("top")).alias("best"))


def _frequent(counts: DataFrame, limit: int) -> tuple[int, pa.Table]:
    """(class, pairs whose count is in that class or a higher one): the lowest class that
    leaves at most ``limit`` pairs.  Classes are eighths of a doubling."""
    level = F.floor(F.log2(F.col("n").cast("double")) * _STEPS)
    left, cut = limit, 64 * _STEPS
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):  # at most 512 rows
        if r["count"] > left:
            break
        left, cut = left - r["count"], r["level"]
    return cut, counts.where(level >= cut).toArrow()


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text",
              frequent: int = FREQUENT) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per
    row of ``docs``.  A pair's count is the number of rows that hold it linked (equal
    ids in several rows are several documents).  Null and empty texts, and those whose
    tokens do not join to a space and the text, have zeros and an empty string in place of the
    digest.  An empty table gives no rows; other columns are not read.  ``frequent``
    only shares the work between tasks and join."""
    spark = docs.sparkSession
    numbered = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    with stored(_describe(numbered, path_a, path_b, "text")) as described:
        width = len(read_model(path_b).pieces)
        with stored(_pair_counts(described, width)) as counts:
            _, table = _frequent(counts, frequent)
            known = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("code", "n", "best")))
            rows = described.where(F.col("row").isNotNull()).drop("code", "n")
            schema = _schemas(docs.schema[id_col].dataType)[1]
            with stored(rows.mapInArrow(_sum_known(known, schema), schema)) as summed:
                rest = (summed.where(F.col("code").isNotNull()).select("row", "code", F.col("n").alias("times"))
                        .join(counts, "code").groupBy("row")
                        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                             F.sum(F.col("n") * F.col("times")).alias("more_sum")))
                out = (summed.where(F.col("code").isNull()).drop("code", "n").join(rest, "row", "left")
                       .select(F.col("id").alias(id_col), *DIGESTS,
                               (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                               (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256"))
                return cut_lineage(out)


def _sum_known(known, schema: T.StructType):
    """Sums over the links to frequent pairs; links to other pairs as rows (row, code, n)."""
    arrow = to_arrow_schema(schema)
    carried = schema.fieldNames()[:-4]

    def run(batches):
        code, n, best = known.value
        index = HashIndex(mix(code.astype(np.uint64)))
        n, best = np.append(n, 0), np.append(best, False).astype(np.int64)
        for batch in batches:
            column = {f: batch.column(i) for i, f in enumerate(batch.schema.names)}
            step = column_bytes(column["codes"].cast(pa.large_binary()))
            times = column_bytes(column["links"].cast(pa.large_binary()))[0].view("<u4").astype(np.int64)
            bounds = step[1] // 4
            some, step = np.diff(bounds), step[0].view("<u4").astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(step)])
            pair = upto[1:] - np.repeat(upto[bounds[:-1]], some)
            row = np.repeat(np.arange(len(some)), some)
            at = index.find(mix(pair.astype(np.uint64)))
            sums = {c: pa.array(np.bincount(row, x[at] * times, len(some)).astype(np.int64)) for c, x in (("n_best", best), ("count_sum", n))}
            yield _batch(arrow, {**{c: column[c] for c in carried}, **sums}, len(some))
            open_ = np.flatnonzero(at < 0)
            if len(open_):
                rows = column["row"].take(pa.array(row[open_]))
                yield _batch(arrow, {"row": rows, "code": pa.array(pair[open_]), "n": pa.array(times[open_])}, len(open_))

    return run
