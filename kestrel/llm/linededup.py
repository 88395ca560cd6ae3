"""Line dedup by content-defined chunks of lines (DataFrame functions only).

A text's non-blank lines are hashed; a rolling hash runs over each of them and the one
before it.  A chunk ends after a line whose rolling hash is a local minimum
(below the next one, not above the one before).  The choice depends on a few
neighbouring lines only, so inserted or removed lines move no boundary further
away, and equal passages of different texts are cut alike.  Two boundaries are
never adjacent, so inner chunks have at least two non-blank lines.  Blank lines take no
part in this: those inside a chunk are part of its bytes, those behind it go where it goes
(those before the first line, with the first chunk).

Chunks of two or more non-blank lines that occur again anywhere in the corpus are
removed except for their first occurrence (smallest id, then text hash, then
place).  Occurrences meet by hash, and their bytes decide: all chunk texts
are grouped by (hash, bytes), and a hash that stands for different bytes removes
nothing.  Grouping combines copies map-side, so a chunk that a third of all documents
hold is one row per task in the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

PRIME, FACTOR = 2147483647, 48271


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long") % PRIME


def _solid(lines: Column) -> Column:
    """Places of the non-blank lines, from 1."""
    return F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), i + 1)), lambda i: i.isNotNull())


def _chunks(lines: Column, at: Column) -> Column:
    """Array of (pos, first, n, top, height, solid) from the lines and the places of the
    non-blank ones (two at least): the chunk's lines with the blank ones behind it, and its lines
    from the first non-blank to the last, all counted from 1."""
    def cut(h: Column) -> Column:
        n = F.size(h)
        roll = F.transform(h, lambda x, i: F.when(i == 0, F.lit(PRIME + 1).cast("long"))
                           .otherwise((x * FACTOR + F.get(h, i - 1)) % PRIME))

        def ends(r: Column) -> Column:
            return F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | ((F.get(r, i - 1) < F.get(r, i))
                                                                            & (F.coalesce(F.get(r, i - 1) <= F.get(r, i - 2), F.lit(False)))))

        def spans(e: Column) -> Column:
            before = F.concat(F.array(F.lit(0)), e)

            def one(x: Column, k: Column) -> Column:
                top = F.get(at, F.get(before, k))
                first = F.when(k == 0, F.lit(1)).otherwise(top)
                until = F.coalesce(F.get(at, x) - 1, F.size(lines))
                return F.struct((k + 1).alias("pos"), first.alias("first"), (until - first + 1).alias("n"), top.alias("top"),
                                (F.get(at, x - 1) - top + 1).alias("height"), (x - F.get(before, k)).alias("solid"))
            return F.transform(e, one)
        return _let(_let(roll, ends), spans)
    return _let(F.transform(at, lambda i: _line_hash(F.get(lines, i - 1))), cut)


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def chunk_rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(_id, _th, pos, first, n, chunk): chunks with two or more non-blank lines."""
    t = docs.where(F.col(text).contains("\n")) \
        .select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th"), _lines(F.col(text)).alias("_lines"))
    t = t.withColumn("_at", _solid(F.col("_lines"))).where(F.size("_at") >= 2)
    c = t.select("_id", "_th", "_lines", F.explode(_chunks(F.col("_lines"), F.col("_at"))).alias("c")).where(F.col("c.solid") >= 2)
    return c.select("_id", "_th", "c.pos", "c.first", "c.n",
                    F.array_join(F.slice("_lines", F.col("c.top"), F.col("c.height")), "\n").alias("chunk"))


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, _th, first, n) of every chunk to remove."""
    chunks = chunk_rows(docs, id_col, text).withColumn("_h", F.xxhash64("chunk"))
    places = cut_lineage(chunks.select("_id", "_th", "pos", "first", "n", "_h").distinct())
    texts = chunks.select("_id", "_th", "pos", "_h", "chunk")
    exact = texts.groupBy("_h", "chunk").agg(F.count(F.lit(1)).alias("k"))
    # stored, so that the joins below shuffle both sides and a hot chunk can be split
    same = cut_lineage(exact.groupBy("_h").agg(F.count(F.lit(1)).alias("kinds"), F.max("k").alias("k"))
                       .where((F.col("kinds") == 1) & (F.col("k") >= 2)).select("_h"))
    again = cut_lineage(places.join(same, "_h"))
    order = F.struct("_id", "_th", "pos")
    firsts = cut_lineage(again.groupBy("_h").agg(F.min(order).alias("_first")))
    return again.join(firsts, "_h").where(order != F.col("_first")).select("_id", "_th", "first", "n")


COUNTS = ("_n_chunks", "_n_lines")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", counts: bool = True, length: str | None = None) -> DataFrame:
    """``docs`` with the lines of repeated chunks taken out of ``text``; with ``counts`` also
    _n_chunks (removed chunks) and _n_lines (removed lines), which replace columns of these names.
    ``length`` names a column that gets the characters left in the texts that changed.

    Every row stays, also if nothing of its text is left (then it is empty).  Null
    and one-line texts are unchanged.  Rows with the same id and text are one
    document: they get the same result and don't count as repeats of each
    other's chunks beyond the first.  A null id sorts before all others.  An empty table
    gives an empty result; other columns are carried along, whatever their names."""
    gone = repeated_chunks(docs, id_col, text).groupBy(F.col("_id").alias("gone_id"), F.col("_th").alias("gone_th")) \
        .agg(F.collect_list(F.struct("first", "n")).alias("gone"))
    # the input travels as one column, so that its names meet none of those used here
    here = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("id"), docs[text].alias("old"),
                       F.xxhash64(docs[text]).alias("th"))
    j = here.join(gone, (F.col("th") == F.col("gone_th")) & F.col("id").eqNullSafe(F.col("gone_id")), "left")
    drop = F.flatten(F.transform("gone", lambda g: F.sequence(g["first"], g["first"] + g["n"] - 1)))

    def left(lines: Column) -> Column:
        keep = F.array_except(F.sequence(F.lit(1), F.size(lines)), drop)
        return F.array_join(F.transform(keep, lambda i: F.get(lines, i - 1)), "\n")

    changed = F.col("gone").isNotNull()
    found = F.coalesce("gone", F.expr("cast(array() as array<struct<first:int,n:int>>)"))
    j = j.select("row", changed.alias("changed"), F.when(changed, _let(_lines(F.col("old")), left)).otherwise(F.col("old")).alias("new"),
                 F.size(found).cast("long").alias("chunks"), F.aggregate(found, F.lit(0), lambda a, g: a + g["n"]).cast("long").alias("lines"))
    cols = []
    for c in docs.columns:
        mine = F.col("row")[c]
        if c == text:
            mine = F.col("new")
        elif c == length:
            mine = F.when(F.col("changed"), F.char_length("new").cast(docs.schema[c].dataType)).otherwise(mine)
        if not (counts and c in COUNTS):
            cols.append(mine.alias(c))
    return j.select(*cols, *([F.col("chunks").alias(COUNTS[0]), F.col("lines").alias(COUNTS[1])] if counts else []))
