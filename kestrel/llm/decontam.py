"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of ``window`` consecutive words (an item of fewer
words is one window).  A window is seen as its sequence of word shingles.  All
shingles of the benchmark are ordered by rarity: how many documents of the
corpus hold them (counted over all documents).  For containment t of m
shingles only the m - ceil(t m) + 1 rarest need to be joined - a document
lacking all of them cannot reach t; whole containment (t = 1) needs just the
rarest one.  A hit of a prefix shingle fixes where the window would start in
the document, so bounds on position and length discard it before the words
themselves are compared one by one.

Benchmark windows are handled in blocks of items with a bounded number of words
(``block_words``), each broadcast to the tasks; texts are never shuffled,
so hot documents, sources or passages cost no more than their own length.  Blocks
are scanned one after another: driver and tasks hold one of them at a time.  What a block
finds is stored under the texts' SHA-256 (equal texts have equal hits), merged by
an aggregate over all blocks and joined back to the documents."""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.scratch import remove
from kestrel.llm.textkit import ALNUM_WORD, LOWER, Chunk, HashIndex, RunHasher, list_column, map_chunks, run_starts
from kestrel.session import cut_lineage, ensure_checkpoint_dir

WINDOW, SHINGLE = 10, 5


class Items:
    """Windows of one block of benchmark items, with their shingles."""

    def __init__(self, rows: list[tuple], window: int, shingle: int):
        self.window, self.shingle = window, shingle
        texts = [(t or "").encode() for _, t in rows]
        self.ids = [i for i, _ in rows]
        offsets = np.cumsum([0, *map(len, texts)]).astype(np.int64)
        w = Chunk(None, np.frombuffer(b"".join(texts), np.uint8), offsets).words(ALNUM_WORD)
        word_hash, run = w.hashes(), RunHasher(w.hashes())
        first, size = [], []
        for a, n in zip(w.row_off[:-1].tolist(), w.counts.tolist()):
            k = max(n - window + 1, 1) if n else 0
            first += range(a, a + k)
            size += [min(n, window)] * k
        first, size = np.array(first, np.int64), np.array(size, np.int64)
        self.item = np.searchsorted(w.row_off, first, "right") - 1
        # equal windows (of one item or several) are looked up once
        self.whole, index = np.unique(run.runs(first, first + size), return_inverse=True)
        order = np.argsort(index, kind="stable")
        self.owners = np.split(self.item[order], np.flatnonzero(np.diff(index[order])) + 1) if len(order) else []
        rep = order[np.searchsorted(index[order], np.arange(len(self.whole)))]
        self.first, self.size = first[rep], size[rep]
        self.width = np.minimum(self.size, shingle)           # shingle length used in this window
        self.words = word_hash
        self.spans = list(zip(w.starts.tolist(), w.ends.tolist()))
        self.raw = w.data.tobytes()
        m = self.size - self.width + 1
        self.win = np.repeat(np.arange(len(m)), m)
        self.at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        a = self.first[self.win] + self.at
        self.gram = run.runs(a, a + self.width[self.win])
        self.widths = np.unique(self.width).tolist()

    def text(self, win: int) -> list[bytes]:
        a, n = int(self.first[win]), int(self.size[win])
        return [self.raw[x:y] for x, y in self.spans[a:a + n]]


def _grams(words, run: RunHasher, width: int) -> tuple[np.ndarray, np.ndarray]:
    at = run_starts(words, width)
    return at, run.runs(at, at + width)


def shingle_counts(docs: DataFrame, items: Items, text: str) -> DataFrame:
    """(gram, n): number of documents that hold each shingle of the block."""
    keys = np.unique(items.gram)
    shared = docs.sparkSession.sparkContext.broadcast((keys, items.widths))

    def one(chunk: Chunk, state):
        index, widths = state
        w = chunk.words(ALNUM_WORD)
        run, row = RunHasher(w.hashes()), w.rows()
        pairs = []
        for k in widths:
            at, g = _grams(w, run, k)
            hit = index.find(g)
            ok = hit >= 0
            pairs.append(np.unique(row[at[ok]].astype(np.int64) * len(index.keys) + hit[ok]))
        n = np.bincount(np.concatenate(pairs) % max(len(index.keys), 1), minlength=len(index.keys)) if pairs else np.zeros(0, int)
        some = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(index.keys[some].view(np.int64)), pa.array(n[some], pa.int64())], names=["gram", "n"])

    part = map_chunks(docs.select(text), "gram long, n long", one, text, lambda: (HashIndex(shared.value[0]), shared.value[1]))
    return part.groupBy("gram").agg(F.sum("n").alias("n"))


class Prefixes:
    """For each window its necessary prefix: the rarest shingles."""

    def __init__(self, items: Items, counts: dict[int, int], containment: float):
        n = np.array([counts.get(g, 0) for g in items.gram.view(np.int64).tolist()], np.int64)
        m = items.size - items.width + 1
        need = np.array([k - math.ceil(containment * k - 1e-9) + 1 for k in m.tolist()], np.int64)
        order = np.lexsort((items.at, items.gram, n, items.win))
        place = np.arange(len(order)) - np.repeat(np.cumsum(m) - m, m)
        order = order[place < need[items.win[order]]]
        # a window with a shingle in no document occurs in none
        rare = np.ones(len(m), bool)
        if containment >= 1:
            rare[items.win[n == 0]] = False
        order = order[rare[items.win[order]]]
        by = order[np.argsort(items.gram[order], kind="stable")]
        self.grams, start = np.unique(items.gram[by], return_index=True)
        self.upto = np.append(start, len(by))
        self.win, self.at = items.win[by], items.at[by]
        self.index = HashIndex(self.grams)


def _candidates(words, run, items: Items, prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """(first word in the chunk, window) of every place that the prefix join
    and the bounds on position and length leave."""
    row_start = np.repeat(words.row_off[:-1], words.counts)
    row_end = np.repeat(words.row_off[1:], words.counts)
    firsts, wins = [], []
    for k in items.widths:
        at, g = _grams(words, run, k)
        hit = prefixes.index.find(g)
        ok = np.flatnonzero(hit >= 0)
        at, hit = at[ok], hit[ok]
        n = prefixes.upto[hit + 1] - prefixes.upto[hit]
        entry = np.repeat(prefixes.upto[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        win, where = prefixes.win[entry], np.repeat(at, n)
        first = where - prefixes.at[entry]
        good = (items.width[win] == k) & (first >= row_start[where]) & (first + items.size[win] <= row_end[where])
        firsts.append(first[good])
        wins.append(win[good])
    return (np.concatenate(firsts), np.concatenate(wins)) if firsts else (np.zeros(0, int), np.zeros(0, int))


def _verified(words, items: Items, first: np.ndarray, win: np.ndarray, run: RunHasher) -> np.ndarray:
    """Exact containment: hashes of the whole window first, then its words."""
    same = run.runs(first, first + items.size[win]) == items.whole[win]
    raw = None
    for i in np.flatnonzero(same).tolist():
        raw = raw if raw is not None else words.data.tobytes()
        a, k = int(first[i]), int(items.size[win[i]])
        got = [raw[x:y] for x, y in zip(words.starts[a:a + k].tolist(), words.ends[a:a + k].tolist())]
        same[i] = got == items.text(int(win[i]))
    return same


def _covered(n: int, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + size, -1)
    return np.cumsum(edge[:-1]) > 0


def scan(chunk: Chunk, items: Items, prefixes: Prefixes) -> tuple:
    """(words per row, hit word spans, (row, item) pairs) of one chunk."""
    w = chunk.words(ALNUM_WORD)
    run = RunHasher(w.hashes())
    first, win = _candidates(w, run, items, prefixes)
    ok = _verified(w, items, first, win, run)
    return w, first[ok], win[ok]


def item_blocks(benchmark: DataFrame, id_col: str, text: str, block_words: int) -> list[DataFrame]:
    """(id, text) of the benchmark in blocks of about ``block_words`` words at most (an item is
    never cut): one block if it is small, else as many hash blocks as its measured
    size asks for.  Rows repeated in full count once."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / 6 / block_words))
    return [rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i) if n > 1 else rows for i in range(n)]


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_words: int = 2_000_000) -> DataFrame:
    """(id, n_words, spans array<struct<first, n>>, items array<string>): per row
    of ``docs`` its number of words, the places of benchmark windows in it and the
    items whose windows occur.  Null texts and texts without words have none;
    null items and items without words have no window; repeated rows and items
    are kept (items are listed once); other columns are not read."""
    src = docs.select(F.col(id_col), F.col(text).alias("_text"))
    blocks = item_blocks(benchmark, item_id, item_text, block_words)
    if len(blocks) == 1:
        return _scan(src, [id_col], _shared(src, blocks[0], window, shingle))
    found = _all_blocks(src.select("_text"), blocks, window, shingle)
    counted = _word_counts(src.withColumn("_key", F.sha2("_text", 256)), id_col)
    none = [F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c) for c in ("spans", "items")]
    return counted.join(found, "_key", "left").select(id_col, "n_words", *none)


def _shared(docs: DataFrame, rows: DataFrame, window: int, shingle: int):
    """Broadcast of one block of items with its prefixes, whose shingles are ordered by
    their numbers of documents."""
    items = Items([(r["id"], r["text"]) for r in rows.collect()], window, shingle)
    counts = {r["gram"]: r["n"] for r in shingle_counts(docs, items, "_text").collect()} if len(items.whole) else {}
    return docs.sparkSession.sparkContext.broadcast((items, Prefixes(items, counts, 1.0)))


#: places (word number, length) of benchmark windows in a row
SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("n", T.LongType())]))


def _scan(src: DataFrame, keep: list[str], shared, hits_only: bool = False) -> DataFrame:
    """Columns ``keep`` with n_words, spans and items of one block for each row; with
    ``hits_only`` for rows that hold a window."""
    schema = T.StructType([*[src.schema[c] for c in keep], T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS),
                           T.StructField("items", T.ArrayType(T.StringType()))])

    def one(chunk: Chunk, block):
        items, prefixes = block
        spans, names = [[] for _ in range(chunk.n)], [set() for _ in range(chunk.n)]
        w, first, win = scan(chunk, items, prefixes)
        row = np.searchsorted(w.row_off, first, "right") - 1
        for r, f, v in zip(row.tolist(), first.tolist(), win.tolist()):
            spans[r].append({"first": f - int(w.row_off[r]), "n": int(items.size[v])})
            names[r].update(items.ids[i] for i in items.owners[v].tolist() if items.ids[i] is not None)
        out = pa.RecordBatch.from_arrays(
            [*[chunk.column(c) for c in keep], pa.array(w.counts, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))),
             pa.array([sorted(x) for x in names], pa.list_(pa.string()))], names=schema.names)
        return out.filter(pa.array([bool(x) for x in spans])) if hits_only else out

    return map_chunks(src, schema, one, "_text", lambda: shared.value)


def _all_blocks(src: DataFrame, blocks: list[DataFrame], window: int, shingle: int) -> DataFrame:
    """(_key, spans, items) of every text that holds a window, over all blocks.  Each
    block's finds are stored before the next one is built; texts without hits leave no row, and
    copies of a text are reduced to one before the shuffle."""
    spark = src.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4()}"
    for i, rows in enumerate(blocks):
        shared = _shared(src, rows, window, shingle)
        got = _scan(src.withColumn("_key", F.sha2("_text", 256)), ["_key"], shared, hits_only=True)
        got.groupBy("_key").agg(F.min(F.struct("spans", "items")).alias("f")).select("_key", "f.*").write.parquet(f"{folder}/block={i}")
        shared.destroy()
    part = spark.read.schema("_key string, spans array<struct<first: long, n: long>>, items array<string>").parquet(
        *[f"{folder}/block={i}" for i in range(len(blocks))])
    merged = part.groupBy("_key").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    out = cut_lineage(merged)
    remove(spark, folder)
    return out


def _word_counts(src: DataFrame, id_col: str) -> DataFrame:
    """(id, _key, n_words) per row."""
    schema = T.StructType([src.schema[id_col], src.schema["_key"], T.StructField("n_words", T.LongType())])

    def one(chunk: Chunk):
        return pa.RecordBatch.from_arrays([chunk.column(id_col), chunk.column("_key"), pa.array(chunk.words(ALNUM_WORD).counts, pa.int64())],
                                          names=schema.names)

    return map_chunks(src, schema, one, "_text")


def contaminated_rows(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Contract columns from :func:`hits`: n_hit counts the words inside any
    occurrence; items_sha256 is over the sorted item ids, comma-joined."""
    def covered(rows):
        for b in rows:
            spans = b.column(b.schema.get_field_index("spans")).to_pylist()
            n = b.column(b.schema.get_field_index("n_words")).to_pylist()
            hit = [int(_covered(k, np.array([x["first"] for x in s], int), np.array([x["n"] for x in s], int)).sum()) if s else 0
                   for s, k in zip(spans, n)]
            names = b.column(b.schema.get_field_index("items")).to_pylist()
            sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(id_col)), pa.array(n, pa.int64()), pa.array(hit, pa.int64()),
                 pa.array([len(x) for x in names], pa.int64()), pa.array(sha), pa.array([h > 0 for h in hit])],
                names=[id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    long = [T.StructField(c, T.LongType()) for c in ("n_words", "n_hit", "n_items")]
    schema = T.StructType([found.schema[id_col], *long, T.StructField("items_sha256", T.StringType()),
                           T.StructField("contaminated", T.BooleanType())])
    return found.mapInArrow(covered, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                      window: int = WINDOW, shingle: int = SHINGLE, block_words: int = 2_000_000) -> DataFrame:
    """Rows of ``docs`` (all columns, whatever their names) without any benchmark window.  Null
    and empty texts hold none and stay; repeated rows are judged alike; an empty
    table gives an empty one, an empty benchmark leaves all rows."""
    src = docs.select(F.col(text).alias("_text"))
    blocks = item_blocks(benchmark, item_id, item_text, block_words)
    if len(blocks) > 1:
        found = _all_blocks(src, blocks, window, shingle).select(F.col("_key").alias("_found"))
        return docs.join(found, F.sha2(docs[text], 256) == found["_found"], "left_anti")
    shared = _shared(src, blocks[0], window, shingle)

    def one(chunk: Chunk, block):
        clean = np.ones(chunk.n, bool)
        w, first, _ = scan(chunk, *block)
        clean[np.searchsorted(w.row_off, first, "right") - 1] = False
        return chunk.rows.filter(pa.array(clean))

    return map_chunks(docs, docs.schema, one, text, lambda: shared.value)
