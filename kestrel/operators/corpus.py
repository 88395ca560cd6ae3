"""Corpus engineering: validation, dedup, merge/split, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def validate_corpus(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(check, n) audit table: orphan labels, unlabeled docs, duplicate ids, blank texts."""
    d_ids = docs.select(id_col)
    l_ids = labels.select(id_col)
    orphan = l_ids.join(d_ids, id_col, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    unlabeled = d_ids.join(l_ids, id_col, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    dups = docs.agg((F.count(F.lit(1)) - F.countDistinct(id_col)).alias("n"))
    blank = docs.where(F.col(text).isNull() | (F.trim(text) == "")).agg(F.count(F.lit(1)).alias("n"))
    parts = [("labels_without_document", orphan), ("documents_without_labels", unlabeled),
             ("duplicate_document_ids", dups), ("blank_texts", blank)]
    out = None
    for name, df in parts:
        df = df.select(F.lit(name).alias("check"), F.col("n").cast("bigint").alias("n"))
        out = df if out is None else out.unionByName(df)
    return out


def share_of_total(per: DataFrame, col: str, base: DataFrame, out: str = "share") -> DataFrame:
    """col / (row count of ``base``), the total as a scalar subquery."""
    from kestrel.functions import scalar
    return per.withColumn(out, F.col(col) / scalar(base.agg(F.count(F.lit(1)).alias("_tot"))))


def merge_split(train: DataFrame, test: DataFrame, id_col: str, exclude_overlap: bool = True, pool: str = "union") -> DataFrame:
    """The merged corpus of two article tables: all columns (those that one side lacks are
    null there), ``split`` (train or test: the table a row comes from) and ``fit`` (whether its id belongs to
    the ids that models are fitted on).

    ``exclude_overlap``: test rows whose id is in train go; otherwise both stay.  ``pool``: 'union' fits on the
    ids of both tables, 'train_only' on those of train, so that an overlapping id that stays is
    fitted on.  Repeated rows of a table stay.  Null ids never overlap and are not fitted on."""
    if pool not in ("union", "train_only"):
        raise ValueError(f"pool must be 'union' or 'train_only', not {pool!r}")
    known = train.select(id_col).distinct()
    te = test.join(known, id_col, "left_anti") if exclude_overlap else test
    tr = train.withColumn("split", F.lit("train"))
    both = tr.unionByName(te.withColumn("split", F.lit("test")), allowMissingColumns=True)
    has_id = F.col(id_col).isNotNull()
    if pool == "union":
        return both.withColumn("fit", has_id)
    if exclude_overlap:
        return both.withColumn("fit", has_id & (F.col("split") == "train"))
    return both.join(known.withColumn("_known", F.lit(True)), id_col, "left").withColumn("fit", F.col("_known").isNotNull()).drop("_known")


def label_dictionary(labels: DataFrame, cat: str = "cat") -> DataFrame:
    """(cat, idx): the labels that occur, numbered from 0 by name.  Null is no label."""
    from kestrel.operators.evaluate import running_totals
    found = labels.where(F.col(cat).isNotNull()).select(cat).distinct().withColumn("one", F.lit(1))
    return running_totals(found, [], cat, ["one"], descending=False).select(cat, (F.col("cum_one") - 1).alias("idx"))


def label_vectors(ids: DataFrame, labels: DataFrame, dictionary: DataFrame, id_col: str = "id", cat: str = "cat") -> DataFrame:
    """(id, indices): the ascending dictionary numbers of each document's labels, the ones of its row
    in the indicator matrix.  Documents without labels have an empty array, repeated labels count once."""
    own = labels.select(id_col, cat).distinct().join(dictionary, cat).groupBy(id_col).agg(F.array_sort(F.collect_list("idx")).alias("indices"))
    return ids.select(id_col).join(own, id_col, "left").select(id_col, F.coalesce("indices", F.array().cast("array<bigint>")).alias("indices"))


def crosstab(ids: DataFrame, labels: DataFrame, categories: DataFrame, id_col: str = "id", cat: str = "cat") -> DataFrame:
    """(id, cat, n): how often each of ``categories`` (a level of the tree) occurs with each id, zeros included."""
    from kestrel.functions import scalar
    per = labels.join(categories.select(cat), cat, "left_semi").groupBy(id_col, cat).agg(F.count(F.lit(1)).alias("n")) \
        .groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct(cat, "n"))).alias("_n"))
    row = ids.select(id_col).join(per, id_col, "left").withColumn("_all", scalar(categories.agg(F.collect_set(cat).alias("_all"))))
    return row.select(id_col, "_n", F.explode("_all").alias(cat)).select(
        id_col, cat, F.coalesce(F.element_at("_n", F.col(cat)), F.lit(0)).alias("n"))


def stratified_split(df: DataFrame, stratum: str, id_col: str, train_pct: int = 80, out: str = "split") -> DataFrame:
    """Exactly ``train_pct`` per cent (rounded) of every stratum's rows are 'train', by a draw from the id.
    Positions come from running counts, so a hot stratum is no single task.  Null is a
    stratum of its own; ids should be unique (equal ones may fall apart)."""
    from kestrel.operators.evaluate import running_totals
    d = df.withColumn("_s", F.to_json(F.struct(stratum))).withColumn("_o", F.struct(draw_key(id_col).alias("h"), F.col(id_col).alias("i")))
    at = running_totals(d.withColumn("_one", F.lit(1)), ["_s"], "_o", ["_one"], descending=False)
    sizes = at.groupBy("_s").agg(F.count(F.lit(1)).alias("_size"))
    quota = F.floor((F.col("_size") * train_pct + 50) / 100)
    return at.join(sizes, "_s").withColumn(out, F.when(F.col("cum__one") <= quota, "train").otherwise("test")).select(*df.columns, out)


def hash_split(df: DataFrame, id_col: str, train_pct: int = 80, mult: int = 7919) -> DataFrame:
    """Stable split from the id alone (no RNG state, no driver round trip); the
    id is reduced first, so 64-bit ids don't overflow the product."""
    b = (F.col(id_col) % 100 * F.lit(mult)) % 100
    return df.withColumn("split", F.when(b < train_pct, "train").otherwise("test"))


def three_way_split(df: DataFrame, id_col: str, train_pct: int = 64, val_pct: int = 16) -> DataFrame:
    """train / val / test from the id alone; the test rows are those of ``hash_split``."""
    b = (F.col(id_col) % 100 * F.lit(7919)) % 100
    return df.withColumn("split", F.when(b < train_pct, "train").when(b < train_pct + val_pct, "val").otherwise("test"))


def pattern_pool(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, pattern): 4-bit pattern quality|toxic|english|long."""
    from kestrel.functions import bit_pattern
    j = docs.select("doc_id", "lang", "n_chars").join(labels.select("doc_id", "quality", "toxic"), "doc_id")
    j = j.withColumn("_en", F.col("lang") == "en").withColumn("_long", F.col("n_chars") > 2000)
    return j.select("doc_id", bit_pattern(F.col("quality") == 1, F.col("toxic") == 1, "_en", "_long").alias("pattern"))


def draw_key(id_col: str) -> F.Column:
    """Deterministic pseudo-random order from the id (portable arithmetic,
    id * 2654435761 mod 1000003 with both factors reduced first)."""
    return (F.col(id_col) % 1000003 * F.lit(2654435761 % 1000003)) % F.lit(1000003)


def top_k_per_group(df: DataFrame, group: str, order: list, k_col: str, salt_buckets: int = 64,
                    salt_of: str | None = None) -> DataFrame:
    """Rows ranked <= k (per-row column ``k_col``) within ``group``, exact.

    Hot groups are split first: rank inside (group, salt) sub-groups, keep
    the top k of each (a row outside its sub-group's top k cannot be in the
    group's top k), then rank the survivors per group.  No task ever sorts a
    whole hot group."""
    salt = F.pmod(F.hash(F.col(salt_of or group), *[F.col(c) for c in order if isinstance(c, str)]), F.lit(salt_buckets))
    s1 = df.withColumn("_salt", salt)
    w1 = Window.partitionBy(group, "_salt").orderBy(*order)
    s1 = s1.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= F.col(k_col))
    w2 = Window.partitionBy(group).orderBy(*order)
    return s1.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= F.col(k_col)).drop("_salt", "_r1", "_r")


def allocate(counts: DataFrame, stratum: str, total: int) -> DataFrame:
    """Proportional allocation of ``total`` draws: banker's rounding of the ideal
    share; the difference to ``total`` is added to (taken from) the strata in
    turn, one each, the largest allocation first, round after round.  Never more than a
    stratum holds nor less than none.  Runs on the per-stratum count table."""
    w_all = Window.partitionBy()
    a = counts.withColumn("ideal", F.lit(float(total)) * F.col("n") / F.sum("n").over(w_all))
    a = a.withColumn("k0", F.bround("ideal", 0).cast("bigint"))
    a = a.withColumn("gap", F.lit(total) - F.sum("k0").over(w_all)).withColumn("m", F.count(F.lit(1)).over(w_all))
    a = a.withColumn("turn", F.row_number().over(Window.orderBy(F.col("k0").desc(), stratum)))
    each = F.floor(F.abs("gap") / F.col("m")) + F.when(F.col("turn") <= F.abs("gap") % F.col("m"), 1).otherwise(0)
    k = F.col("k0") + F.signum("gap").cast("bigint") * each
    return a.select(stratum, "n", F.least(F.col("n"), F.greatest(k, F.lit(0))).alias("k"))


def stratified_sample(pool: DataFrame, stratum: str, id_col: str, total: int) -> DataFrame:
    counts = pool.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    alloc = allocate(counts, stratum, total)
    j = pool.join(alloc.select(stratum, "k"), stratum)   # one row per stratum (AQE broadcasts it)
    j = j.withColumn("_h", draw_key(id_col))
    return top_k_per_group(j, stratum, ["_h", id_col], "k", salt_of=id_col).select(id_col, stratum)


def presence_drift(pool: DataFrame, sample: DataFrame, pattern: str, bits: dict[str, int]) -> DataFrame:
    """Per flag bit: presence rate in pool vs sample and the change in pp."""
    def rates(df, name):
        return df.agg(*[F.avg(F.shiftright(F.col(pattern), b).bitwiseAND(F.lit(1))).alias(f) for f, b in bits.items()]) \
            .unpivot([], list(bits), "flag", name)
    j = rates(pool, "pool_rate").join(rates(sample, "sample_rate"), "flag")
    return j.withColumn("delta_pp", 100 * (F.col("sample_rate") - F.col("pool_rate")))


def leaf_cap_sample(leafdocs: DataFrame, cat: str, id_col: str, min_docs: int, cap: int) -> DataFrame:
    ok = leafdocs.groupBy(cat).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
    j = leafdocs.join(ok.select(cat), cat).withColumn("_k", F.lit(cap)).withColumn("_h", draw_key(id_col))
    return top_k_per_group(j, cat, ["_h", id_col], "_k", salt_of=id_col).select(id_col).distinct()


def pack_labels(df: DataFrame, id_col: str, level: str, cat: str, sep: str = ";") -> DataFrame:
    item = F.concat(F.col(level).cast("string"), F.lit(":"), F.col(cat))
    return df.groupBy(id_col).agg(F.concat_ws(sep, F.array_sort(F.collect_list(item))).alias("packed"))
