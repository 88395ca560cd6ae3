"""Repeated passages by a sparse suffix array, with hash aggregates in place of the sort.

Suffixes: of every window of ``length`` words the word run (``seed`` words) with the
smallest hash is its minimiser; only suffixes that start at a minimiser are kept (about
one in (length - seed) / 2 positions).  Equal windows choose the same place, so every
passage of at least ``length`` words holds a retained suffix at the same place of
each of its occurrences.

Order: nothing is sorted.  Suffixes are grouped by the hash of their first ``seed``
words, then by the hash of their whole context (the words left and right that any
window through the seed can reach).  Suffixes that share the first key have a common
prefix; those that share both agree as far as a window can extend to either side.

Extension: members of one context are repeats over their full extent.
Where one seed stands in several contexts, one occurrence of each context is extended
left and right, window by window, by comparing the windows whose minimiser it is;
the matches give the extent for all occurrences of that context.  No pairs of a
group are formed: groups are reduced by aggregates, and work is linear in the number
of occurrences.

Links: each occurrence points to the first one of its passage (document, text key and
place), itself included.  All occurrences of a window point to the same place, so two
documents share a window exactly if they point to the same ``length`` words.  Words are compared by 64-bit hashes of the runs (seed, context and
window each)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.scratch import stored
from kestrel.llm.textkit import SPACE_WORD, Chunk, RunHasher, U64, map_chunks, mix, run_starts
from kestrel.session import cut_lineage

LENGTH, SEED = 50, 16


class Minimisers:
    """Windows of a chunk and the place of each one's minimiser."""

    def __init__(self, chunk: Chunk, length: int, seed: int):
        self.words = w = chunk.words(SPACE_WORD, lower=False)
        self.run = RunHasher(w.hashes())
        self.grams = run_starts(w, seed)                        # word numbers
        self.hash = self.run.runs(self.grams, self.grams + seed)
        span = length - seed + 1
        rows = w.rows()[self.grams]
        n = len(self.grams) - span + 1
        if n <= 0:
            self.window = self.seed_at = np.zeros(0, np.int64)
            return
        whole = np.flatnonzero(rows[:n] == rows[span - 1:])
        best = np.empty(n, np.int64)
        view = np.lib.stride_tricks.sliding_window_view(self.hash, span)
        for a in range(0, n, 1 << 16):
            best[a:a + (1 << 16)] = view[a:a + (1 << 16)].argmin(axis=1)
        self.window = self.grams[whole]                         # first word of each window
        self.seed_at = whole + best[whole]                      # its seed, as an index into grams


def suffixes(src: DataFrame, length: int, seed: int) -> DataFrame:
    """(_id, _key, h, ctx, pos, left, right): retained suffixes with the hashes of seed and context."""

    def one(chunk: Chunk):
        m = Minimisers(chunk, length, seed)
        w = m.words
        at = np.unique(m.seed_at)
        p = m.grams[at]
        row = w.rows()[p]
        left = np.minimum(p - w.row_off[row], length - seed)
        right = np.minimum(w.row_off[row + 1] - p, length)
        with np.errstate(over="ignore"):
            ctx = mix(m.run.runs(p - left, p + right) + left.astype(U64) * U64(0x9E3779B97F4A7C15))
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [chunk.column("_id").take(take), chunk.column("_key").take(take), pa.array(m.hash[at].view(np.int64)), pa.array(ctx.view(np.int64)),
             pa.array((p - w.row_off[row]).astype(np.int32)), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32))], names=schema.names)

    long, integer = T.LongType(), T.IntegerType()
    schema = T.StructType([src.schema["_id"], *[T.StructField(c, long) for c in ("_key", "h", "ctx")],
                           *[T.StructField(c, integer) for c in ("pos", "left", "right")]])
    return map_chunks(src, schema, one, "_text")


def _several() -> Column:
    """More than one place (copies of a row share their places)."""
    return (F.min("_key") != F.max("_key")) | (F.min("pos") != F.max("pos"))


def _windows(reps: DataFrame, length: int, seed: int) -> DataFrame:
    """(w, _id, _key, a, h, ctx, o): windows whose minimiser is one of the listed
    suffixes ``_seeds`` of their row; o: words of the window left of it."""

    def one(chunk: Chunk):
        m = Minimisers(chunk, length, seed)
        w = m.words
        lists = chunk.column("_seeds")
        off = np.array(lists.offsets, np.int64)
        off -= off[0]
        flat = lists.flatten()
        pos, ctx = np.array(flat.field("pos"), np.int64), np.array(flat.field("ctx"), np.int64)
        owner = np.repeat(np.arange(chunk.n), np.diff(off))
        wanted = w.row_off[owner] + pos
        order = np.argsort(wanted, kind="stable")
        wanted, ctx = wanted[order], ctx[order]
        place = m.grams[m.seed_at]
        i = np.searchsorted(wanted, place)
        ok = np.flatnonzero((i < len(wanted)) & (wanted[np.minimum(i, max(len(wanted) - 1, 0))] == place)) if len(wanted) else np.zeros(0, int)
        a = m.window[ok]
        row = w.rows()[a]
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(m.run.runs(a, a + length).view(np.int64)), chunk.column("_id").take(take), chunk.column("_key").take(take),
             pa.array((a - w.row_off[row]).astype(np.int32)), pa.array(m.hash[m.seed_at[ok]].view(np.int64)), pa.array(ctx[i[ok]]),
             pa.array((place[ok] - a).astype(np.int32))], names=schema.names)

    long, integer = T.LongType(), T.IntegerType()
    schema = T.StructType([T.StructField("w", long), reps.schema["_id"], T.StructField("_key", long), T.StructField("a", integer),
                           T.StructField("h", long), T.StructField("ctx", long), T.StructField("o", integer)])
    return map_chunks(reps, schema, one, "_text")


SHIFT = 32   # word numbers have 31 bits


def merged_runs(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, start, end, a member's index) of the intervals that remain when those of a group which meet or overlap are merged,
    by group and start.  Groups are numbers from 0."""
    order = np.lexsort((start, group))
    base = group[order].astype(np.int64) << SHIFT
    s, e = base + start[order], base + end[order]
    reach = np.maximum.accumulate(e)
    first = np.flatnonzero(np.concatenate([[True], s[1:] > reach[:-1]])) if len(s) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(s))[:len(first)] - 1
    return group[order[first]], start[order[first]], (reach[last] - base[last]).astype(start.dtype), order[first]


class Passages:
    """Merged intervals of some documents, numbered from 0: spans, those to remove, links.  ``first``: an Arrow
    array, the id of each link's first document."""

    def __init__(self, spans, gone, links, first: pa.Array):
        doc, start, end, key, shift = links
        self.spans, self.gone = merged_runs(*spans)[:3], merged_runs(*gone)[:3]
        order = np.lexsort((shift, key, doc))
        new = np.ones(len(order), bool)
        for x in (doc, key, shift):
            new[1:] &= x[order][1:] == x[order][:-1]
        new[1:] = ~new[1:]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        _, s, e, at = merged_runs(group, start, end)
        doc, key, shift = doc[at], key[at], shift[at]
        order = np.lexsort((s + shift, key, e, s, doc))
        self.links, self.first = tuple(x[order] for x in (doc, s, e, key, shift)), first.take(pa.array(at[order]))

    @classmethod
    def of(cls, rows: pa.RecordBatch, doc: np.ndarray, before: "Passages | None" = None) -> Passages:
        """``rows``: (s, e, rs, re, links), ``doc`` their documents; ``before``: what is known of document 0."""
        part = {c: rows.column(rows.schema.get_field_index(c)) for c in ("s", "e", "rs", "re", "links")}
        some = np.flatnonzero(part["rs"].is_valid().to_numpy(zero_copy_only=False))
        number = {c: part[c].fill_null(0).to_numpy(zero_copy_only=False) for c in ("s", "e", "rs", "re")}
        flat = part["links"].flatten()
        field = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "end", "first_key", "first_pos")}
        size = part["links"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        first, spans, gone = flat.field("first_doc"), (doc, number["s"], number["e"]), (doc[some], number["rs"][some], number["re"][some])
        links = np.repeat(doc, size), field["start"], field["end"], field["first_key"], field["first_pos"] - field["start"]
        if before is not None:
            spans, gone, links = (tuple(map(np.concatenate, zip(x, y))) for x, y in ((before.spans, spans), (before.gone, gone), (before.links, links)))
            first = pa.concat_arrays([before.first, first])
        return cls(spans, gone, links, first)

    def cut(self, a: int, b: int) -> Passages:
        """Documents a to b, numbered from 0."""
        new = object.__new__(Passages)
        part = [np.searchsorted(x[0], (a, b)) for x in (self.spans, self.gone, self.links)]
        new.spans, new.gone, new.links = (tuple([x[0][i:j] - a, *(y[i:j] for y in x[1:])]) for x, (i, j) in zip((self.spans, self.gone, self.links), part))
        new.first = self.first.slice(part[2][0], part[2][1] - part[2][0])
        return new

    def columns(self, n: int, field: pa.DataType) -> list[pa.Array]:
        """Of ``n`` documents: spans, their words, those to remove, their words, links."""
        out = []
        for doc, s, e in (self.spans, self.gone):
            flat = pa.StructArray.from_arrays([pa.array(s, pa.int32()), pa.array(e, pa.int32())], names=["start", "end"])
            out += [_lists(doc, flat, n), pa.array(np.bincount(doc, e - s, n).astype(np.int64))]
        doc, s, e, key, shift = self.links
        named = {"start": pa.array(s, pa.int32()), "end": pa.array(e, pa.int32()), "first_doc": self.first, "first_key": pa.array(key, pa.int64()),
                 "first_pos": pa.array(s + shift, pa.int32())}
        return [*out, _lists(doc, pa.StructArray.from_arrays([named[f.name] for f in field], fields=list(field)), n)]


def _lists(doc: np.ndarray, flat: pa.Array, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)), flat)


#: rows that are merged at once
MERGE_ROWS = 4096


def merged_batches(batches, names: list[str]):
    """Rows (_id, _key, _first, s, e, rs, re, links), those of a document one after another, to one row a document.  Memory
    is that of ``MERGE_ROWS`` rows and of what remains of one document, however many rows it has."""
    held, done = None, None     # the last document: its row of ids, its passages

    def result(ids, passages, n, field):
        spans, size, gone, n_gone, links = passages.columns(n, field)
        return pa.RecordBatch.from_arrays([ids.column(0), spans, size, gone, n_gone, ids.column(2), links], names=names)

    field = None
    for batch in batches:
        for at in range(0, batch.num_rows, MERGE_ROWS):
            rows = batch.slice(at, MERGE_ROWS)
            field = rows.schema.field("links").type.value_type
            key = rows.column(1).to_numpy()
            new = np.concatenate([[True], key[1:] != key[:-1]])
            doc, ids = np.cumsum(new) - 1, pa.RecordBatch.from_arrays(rows.columns[:3], names=rows.schema.names[:3]).take(pa.array(np.flatnonzero(new)))
            same = held is not None and held.column(1)[0].as_py() == key[0]
            if held is not None and not same:
                yield result(held, done, 1, field)
            passages, n = Passages.of(rows, doc, done if same else None), len(ids)
            if n > 1:
                yield result(ids.slice(0, n - 1), passages.cut(0, n - 1), n - 1, field)
            held, done = ids.slice(n - 1), passages.cut(n - 1, n)
    if held is not None:
        yield result(held, done, 1, field)


def _merged(rows: DataFrame, id_col: str) -> DataFrame:
    """One row per document: its intervals merged, those to remove too, and its links
    (those to the same text and shift merged).  ``rows``: as for ``merged_batches``."""
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    kind = rows.schema["_id"].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("spans", span), T.StructField("n_repeated", T.LongType()),
                           T.StructField("removable", span), T.StructField("n_removable", T.LongType()), T.StructField("first_doc", kind),
                           T.StructField("links", rows.schema["links"].dataType)])
    names = schema.names
    return rows.mapInArrow(lambda batches: merged_batches(batches, names), schema)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(id, spans, n_repeated, removable, n_removable, first_doc, links): one row per
    document that holds a passage of at least ``length`` words occurring
    twice or more in the corpus (in other documents or elsewhere in the same one).

    spans: the words (numbered from 0, end exclusive) inside such passages; removable: the
    part whose passage also stands earlier (smaller id, then place), which can be
    cut without losing any passage altogether; first_doc: the smallest id that holds one of
    the document's passages.  links: (start, end, first_doc, first_key, first_pos) of every
    passage: words start to end are those from word first_pos of the passage's first
    occurrence, in the text of first_doc with xxhash64(id, text) = first_key.  Each window of
    ``length`` words has one first occurrence, to which all its occurrences have a link (the first
    one to itself): documents share it if their links meet there in ``length`` words.  Words are runs of non-white-space, compared as they
    stand.  Null and short texts hold no passage; rows repeated in full (same id and
    text) are one document; a null id sorts first; an empty table gives an empty
    result; other columns are not read."""
    src = docs.select(F.col(id_col).alias("_id"), F.xxhash64(id_col, text).alias("_key"), F.col(text).alias("_text"))
    with stored(suffixes(src, length, seed)) as all_suffixes:
        # stored, so that the join below shuffles both sides and a hot seed can be split
        repeated = cut_lineage(all_suffixes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
        kept = cut_lineage(all_suffixes.join(repeated, "h"))
    order = F.struct("_id", "_key", "pos")
    classes = kept.groupBy("h", "ctx").agg(F.min(order).alias("rep"), _several().alias("full"))
    classes = cut_lineage(classes)
    groups = cut_lineage(classes.groupBy("h").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1"))
    reps = classes.join(groups, "h").groupBy(F.col("rep._key").alias("_key")) \
        .agg(F.collect_list(F.struct(F.col("rep.pos").alias("pos"), "ctx")).alias("_seeds"))
    wins = cut_lineage(_windows(src.join(reps, "_key").select("_id", "_key", "_seeds", "_text"), length, seed))
    here = F.struct("_id", "_key", "a")
    twice = wins.groupBy("w").agg(F.min(here).alias("f"), ((F.min("_key") != F.max("_key")) | (F.min("a") != F.max("a"))).alias("_r")).where("_r")
    late = F.when(here != F.col("f"), F.col("o"))
    # per context and place of the seed in the windows' first occurrence: their range
    firsts = wins.join(cut_lineage(twice.select("w", "f")), "w") \
        .groupBy("h", "ctx", F.col("f._id").alias("fid"), F.col("f._key").alias("fkey"), (F.col("f.a") + F.col("o")).alias("fpos")) \
        .agg(F.min("o").alias("omin"), F.max("o").alias("omax"), F.min(late).alias("rmin"), F.max(late).alias("rmax"))
    part = firsts.groupBy("h", "ctx").agg(
        F.min("omin").alias("omin"), F.max("omax").alias("omax"), F.min("rmin").alias("rmin"), F.max("rmax").alias("rmax"), F.min("fid").alias("fid"),
        F.collect_list(F.struct("omin", "omax", "fid", "fkey", "fpos")).alias("_at"))
    known = cut_lineage(classes.join(part, ["h", "ctx"], "left").where(F.col("full") | F.col("omin").isNotNull()))
    m = kept.join(known, ["h", "ctx"])
    p, again = F.col("pos"), F.col("full") & (F.struct("_id", "_key", "pos") != F.col("rep"))

    def link(start, end, doc, key, pos):
        return F.struct(start.alias("start"), end.alias("end"), doc.alias("first_doc"), key.alias("first_key"), pos.alias("first_pos"))

    whole = link(p - F.col("left"), p + F.col("right"), F.col("rep._id"), F.col("rep._key"), F.col("rep.pos") - F.col("left"))
    some = F.transform("_at", lambda x: link(p - x["omax"], p - x["omin"] + length, x["fid"], x["fkey"], x["fpos"] - x["omax"]))
    links = F.when(F.col("_at").isNull(), F.array(whole)).when(F.col("full"), F.concat(F.array(whole), some)).otherwise(some)
    parts = m.select(
        "_id", "_key",
        F.when(F.col("full"), p - F.col("left")).otherwise(p - F.col("omax")).alias("s"),
        F.when(F.col("full"), p + F.col("right")).otherwise(p - F.col("omin") + length).alias("e"),
        F.when(again, p - F.col("left")).otherwise(p - F.col("rmax")).alias("rs"),
        F.when(again, p + F.col("right")).otherwise(p - F.col("rmin") + length).alias("re"),
        F.when(F.col("full") & F.col("fid").isNotNull(), F.least("rep._id", "fid")).when(F.col("full"), F.col("rep._id"))
        .otherwise(F.col("fid")).alias("_fid"), links.alias("_links"))
    # a document's parts are collected without repeats, then sent on row by row: a batch is bounded by its rows
    per = parts.groupBy("_key").agg(F.first("_id").alias("_id"), F.min("_fid").alias("_first"),
                                    F.collect_set(F.struct("s", "e", "rs", "re", F.col("_links").alias("links"))).alias("_parts"))
    return _merged(per.select("_id", "_key", "_first", F.inline("_parts")), id_col)
