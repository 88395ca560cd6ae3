"""Classification metrics as aggregations: confusion counts, derived ratios
with zero_division = 0, rank-based AUC, average precision, best-F1 threshold,
pooled / macro / positive-weighted summaries and multilabel F1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _z(num: Column, den: Column) -> Column:
    """ratio with zero_division = 0"""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion(df: DataFrame, y: str, pred: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    Y, P_ = F.col(y), F.col(pred)
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.count(F.when((Y == 1) & (P_ == 1), 1)).alias("tp"), F.count(F.when((Y == 0) & (P_ == 1), 1)).alias("fp"),
                 F.count(F.when((Y == 1) & (P_ == 0), 1)).alias("fn"), F.count(F.when((Y == 0) & (P_ == 0), 1)).alias("tn"))


def ratios(df: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec, rec = _z(tp, tp + fp), _z(tp, tp + fn)
    return df.withColumns({"accuracy": _z(tp + tn, tp + fp + fn + tn), "precision": prec, "recall": rec,
                           "f1": _z(2 * tp, 2 * tp + fp + fn)})


def binary_metrics(df: DataFrame, y: str, pred: str, by: list[str] | None = None) -> DataFrame:
    return ratios(confusion(df, y, pred, by))


def running_totals(df: DataFrame, by: list[str], order: str, cols: list[str], descending: bool = True,
                   partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` per ``by`` group in ``order``,
    computed without a per-group window over the whole group.

    Rows are range-partitioned on (by, order); each range partition computes
    its local running sums; a small table of per-partition totals (one row per
    partition and group) yields the offsets that are added back.  No task holds
    more than one range partition, however large a group is."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    o = F.col(order).desc() if descending else F.col(order).asc()
    from kestrel.session import cut_lineage
    # materialise once: both branches below must see the same range partitions
    r = cut_lineage(df.repartitionByRange(n, *[F.col(c) for c in by], o).withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid", *by).orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    local = r.select("*", *[F.sum(c).over(w).alias(f"_loc_{c}") for c in cols])
    tot = r.groupBy("_pid", *by).agg(*[F.sum(c).alias(f"_tot_{c}") for c in cols])
    # offsets: totals of earlier range partitions of the same group (tiny table)
    wo = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_pid", *by, *[F.coalesce(F.sum(f"_tot_{c}").over(wo), F.lit(0)).alias(f"_off_{c}") for c in cols])
    # ~ (#groups + #partitions) rows: AQE broadcasts it when its measured size is small
    out = local.join(off, ["_pid", *by])
    return out.select(*[c for c in df.columns], *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in cols])


def _score_counts(df: DataFrame, y: str, score: str, by: list[str]) -> DataFrame:
    """(by, score, p, n): positives / negatives per distinct score (partial agg)."""
    return df.groupBy(*by, score).agg(F.count(F.when(F.col(y) == 1, 1)).alias("_p"),
                                      F.count(F.when(F.col(y) == 0, 1)).alias("_n"))


def roc_auc(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Mann-Whitney AUC, ties counted one half: sum over distinct scores of
    p(s) * (negatives below s + n(s) / 2) / (P N)."""
    by = by or []
    c = running_totals(_score_counts(df, y, score, by), by, score, ["_n"], descending=False)
    below = F.col("cum__n") - F.col("_n")
    g = c.groupBy(*by) if by else c.groupBy()
    s = g.agg(F.sum(F.col("_p") * (below + F.col("_n") / 2.0)).alias("_u"), F.sum("_p").alias("n_pos"),
              F.sum("_n").alias("n_neg"))
    return s.select(*by, "n_pos", "n_neg", (F.col("_u") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"))


def per_threshold(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """One row per distinct score: positives / negatives at or above it, and
    the group's positive total."""
    by = by or []
    c = running_totals(_score_counts(df, y, score, by), by, score, ["_p", "_n"], descending=True)
    if by:
        pos = c.groupBy(*by).agg(F.sum("_p").alias("pos"))   # one row per label
        c = c.join(pos, by)
    else:
        from kestrel.functions import attach_scalars
        c = attach_scalars(c, c.agg(F.sum("_p").alias("pos")))
    return c.select(*by, F.col(score).alias("thr"), F.col("_p").alias("p_at"), F.col("cum__p").alias("tp"),
                    F.col("cum__n").alias("fp"), "pos")


def average_precision(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """AP = sum over distinct thresholds of (new positives / P) * precision."""
    by = by or []
    t = per_threshold(df, y, score, by)
    g = t.groupBy(*by) if by else t.groupBy()
    return g.agg(F.sum(F.col("p_at") / F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("ap"))


def best_f1_threshold(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Exact F1 at every distinct score (predict score >= thr); the first
    maximum in ascending threshold order wins (max_by with partial aggregation)."""
    by = by or []
    t = per_threshold(df, y, score, by)
    t = t.withColumn("f1", _z(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("pos")))
    key = F.struct(F.col("f1"), (-F.col("thr")).alias("neg_thr"))
    best = F.max_by(F.struct("thr", "f1", "tp", "fp", "pos"), key).alias("b")
    g = t.groupBy(*by) if by else t.groupBy()
    return g.agg(best).select(*by, "b.thr", "b.f1", "b.tp", "b.fp", "b.pos")


def summarize(per: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Pooled (micro), macro and positive-weighted P/R/F1 over per-unit
    confusion rows (units with < 2 classes are skipped for the weighted mean)."""
    key = key or []
    per = ratios(per).withColumn("_pos", F.col("tp") + F.col("fn"))
    g = per.groupBy(*key) if key else per.groupBy()
    tp, fp, fn, tn = (F.sum(c) for c in ("tp", "fp", "fn", "tn"))
    two = (F.col("_pos") > 0) & (F.col("_pos") < F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    wsum = F.sum(F.when(two, F.col("_pos")))
    return g.agg(
        F.count(F.lit(1)).alias("units"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        _z(tp, tp + fp).alias("micro_precision"), _z(tp, tp + fn).alias("micro_recall"),
        _z(2 * tp, 2 * tp + fp + fn).alias("micro_f1"), _z(tp + tn, tp + fp + fn + tn).alias("micro_accuracy"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"),
        (F.sum(F.when(two, F.col("_pos") * F.col("precision"))) / wsum).alias("weighted_precision"),
        (F.sum(F.when(two, F.col("_pos") * F.col("recall"))) / wsum).alias("weighted_recall"),
        (F.sum(F.when(two, F.col("_pos") * F.col("f1"))) / wsum).alias("weighted_f1"))


def multilabel_f1(gold: DataFrame, pred: DataFrame, id_col: str, label: str, universe: DataFrame) -> DataFrame:
    """Leaf multilabel F1 (micro / macro over all labels in ``universe`` /
    support-weighted / samples) from a full outer join on (id, label)."""
    g = gold.select(id_col, label, F.lit(1).alias("_g")).distinct()
    p = pred.select(id_col, label, F.lit(1).alias("_p")).distinct()
    j = g.join(p, [id_col, label], "full")
    per_label = j.groupBy(label).agg(F.count(F.when(F.col("_g").isNotNull() & F.col("_p").isNotNull(), 1)).alias("tp"),
                                     F.count(F.when(F.col("_g").isNull(), 1)).alias("fp"),
                                     F.count(F.when(F.col("_p").isNull(), 1)).alias("fn"))
    per_label = universe.select(label).join(per_label, label, "left").na.fill(0, ["tp", "fp", "fn"])
    per_label = per_label.withColumn("f1", _z(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))
    per_id = j.groupBy(id_col).agg(F.count(F.when(F.col("_g").isNotNull() & F.col("_p").isNotNull(), 1)).alias("tp"),
                                   F.count(F.when(F.col("_g").isNull(), 1)).alias("fp"),
                                   F.count(F.when(F.col("_p").isNull(), 1)).alias("fn"))
    samples = per_id.agg(F.avg(_z(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))).alias("samples_f1"))
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    sup = F.col("tp") + F.col("fn")
    lab = per_label.agg(_z(2 * tp, 2 * tp + fp + fn).alias("micro_f1"), F.avg("f1").alias("macro_f1"),
                        _z(F.sum(sup * F.col("f1")), F.sum(sup)).alias("weighted_f1"))
    from kestrel.functions import attach_scalars
    return attach_scalars(lab, samples)
