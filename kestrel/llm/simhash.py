"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: each word shingle's XXH64 votes on 64 bits; a bit is set if over
half of the shingles (repeats included) set it.

Candidates: every bit position i gets a non-zero vector m(i) of radius+1 bits,
dealt evenly over the 2^(radius+1)-1 vectors.  Table v (one for each non-zero
v) keeps the bits with odd <m(i), v>.  Up to ``radius`` differing bits impose at
most ``radius`` linear conditions on v, so some non-zero v ignores all of
them: every pair within the radius has equal masked fingerprints in some table
(no probability involved).

Links: only distinct fingerprints are compared.  A bucket of up to
``pair_limit`` fingerprints is checked pair by pair.  In a fuller bucket no
pairs are made: each fingerprint emits the points that lie half the radius
around it; fingerprints that share a point are within the radius of each
other (radius 2: points at one bit), so all of them link to the
smallest one - linear in the bucket, with the same components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.components import connected_components
from kestrel.llm.textkit import map_chunks
from kestrel.session import cut_lineage

SEED = 42
_BLOCK = 1 << 17


def _signed(x: int) -> int:
    return x - 2 ** 64 if x >= 2 ** 63 else x


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of one UTF-8 text (words between ASCII white space, A-Z lower-cased)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) <= shingle:
        starts, ends = [0], [len(joined)]
    else:
        starts, ends = starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    votes, h, n = np.zeros(64, np.int64), xxhash.xxh64_digest, len(starts)
    for i in range(0, n, _BLOCK):
        raw = b"".join([h(joined[a:b], SEED) for a, b in zip(starts[i:i + _BLOCK], ends[i:i + _BLOCK])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(_id, _text_hash, fp): signed 64-bit fingerprint per row; null or
    wordless text: 0."""

    def one(chunk):
        fp = np.fromiter((fingerprint(t, shingle) for t in chunk.texts()), np.uint64, chunk.n)
        return pa.RecordBatch.from_arrays([chunk.column("_id"), chunk.column("_text_hash"), pa.array(fp.view(np.int64))],
                                          names=["_id", "_text_hash", "fp"])

    src = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text_hash"), F.col(text).alias("_text"))
    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_text_hash", T.LongType()),
                           T.StructField("fp", T.LongType())])
    return map_chunks(src, schema, one, "_text")


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1)-1 structured masks of 64 bits (as signed longs)."""
    size = 2 ** (radius + 1)
    return [_signed(sum(1 << i for i in range(64) if (1 + i % (size - 1) & v).bit_count() % 2)) for v in range(1, size)]


def _points(radius: int) -> list[int]:
    """All flips of at most radius / 2 bits."""
    return [_signed(sum(1 << i for i in c)) for k in range(radius // 2 + 1) for c in combinations(range(64), k)]


def links(fps: DataFrame, radius: int = 2, pair_limit: int = 32) -> DataFrame:
    """(a, b): links between distinct fingerprints, enough to connect every pair
    that differs in at most ``radius`` bits; every link is such a pair."""
    if radius % 2:
        raise ValueError("the half-radius step needs an even radius")
    masks = covering_masks(radius)
    table = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
    keyed = fps.select("fp", table.alias("v", "key"))
    sizes = cut_lineage(keyed.groupBy("v", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = cut_lineage(keyed.join(sizes, ["v", "key"]))
    few = shared.where(F.col("n") <= pair_limit)
    x, y = few.select("v", "key", F.col("fp").alias("a")), few.select("v", "key", F.col("fp").alias("b"))
    near = x.join(y, ["v", "key"]).where(F.col("a") > F.col("b"))
    near = near.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
    many = shared.where(F.col("n") > pair_limit).select("fp").distinct()
    flips = F.explode(F.array(*[F.lit(p) for p in _points(radius)]))
    spread = many.select("fp", flips.alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    least = spread.groupBy("point").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hung = spread.join(least, "point").where(F.col("fp") != F.col("b")).select(F.col("fp").alias("a"), "b")
    return near.unionByName(hung).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2,
                    pair_limit: int = 32) -> DataFrame:
    """(id, fingerprint, component_id) per input row.

    Rows whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest non-null id reachable.  Null and wordless
    texts have fingerprint zero and link like any other.  Repeated rows stay,
    each with the same component; a null id stays null and gets the component
    of its fingerprint.  An empty table gives an empty result; other columns are not
    read."""
    rows = cut_lineage(fingerprints(docs, id_col, text, shingle))
    classes = classes_of(rows, radius, pair_limit)
    return rows.join(classes, "fp").select(F.col("_id").alias(id_col),
                                           F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def classes_of(rows: DataFrame, radius: int, pair_limit: int = 32) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of (_id, fp)
    rows; ``root`` is the component's smallest fingerprint."""
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("_id").alias("_first")))
    roots = connected_components(links(nodes.select("fp"), radius, pair_limit), "a", "b")
    rooted = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    rooted = cut_lineage(rooted)
    least = cut_lineage(rooted.groupBy("root").agg(F.min("_first").alias("component_id")))  # the join can split a hot class
    return cut_lineage(rooted.join(least, "root").select("fp", "root", "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2,
             pair_limit: int = 32) -> DataFrame:
    """Rows of ``docs`` with one row left of each near-duplicate component: the
    one with the smallest id (a null id only where the component has no other).
    If that id stands on several texts of the component, the text with the
    smallest hash stays; of rows with equal id and text the one with the smallest hash of all
    columns, of rows repeated in full one.  Null and wordless texts are one component.  An empty
    table gives an empty result; other columns are carried along, whatever their names."""
    rows = cut_lineage(fingerprints(docs, id_col, text, shingle))
    classes = classes_of(rows, radius, pair_limit)
    firsts = rows.join(classes, "fp").where(F.col("_id").eqNullSafe(F.col("component_id")))
    one = firsts.groupBy("root").agg(F.min(F.struct("_id", "_text_hash")).alias("k")).select("k.*")
    # the input travels as one column, so that its names meet none of those used here
    here = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("id"), F.xxhash64(docs[text]).alias("th"))
    same = F.col("th").eqNullSafe(F.col("_text_hash")) & F.col("id").eqNullSafe(F.col("_id"))
    kept = here.join(one, same).groupBy("id", "th").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
