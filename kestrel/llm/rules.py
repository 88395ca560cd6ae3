"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Signals of a whole text are compared with cutoffs that are chosen per stratum
from labelled holdouts.  The cutoffs of all rules are tightened along one fixed path
that is written down before any label is seen: it starts with no rule in use, and
its steps tighten the rules in turn, each to its next cutoff.  A step stands for the joint
verdict of all cutoffs reached so far: a document is rejected from the first step on
at which one of its signals is above the cutoff.

For a stratum and a step let x of the n good holdout documents be rejected.  The step is
certified if the exact binomial tail P(Bin(n, alpha) <= x) is at most the stratum's
share of delta: then a false rejection rate above alpha is refuted at that level.  Steps are
tested in their fixed order and testing stops at the first failure, so the sequence needs
no correction and every rule has the full alpha; over strata delta is divided
evenly (Bonferroni).  With confidence 1 - delta no stratum loses more than alpha of
its good documents to the rules.

Among the certified steps of a stratum the one is used that rejects most bad minus
good holdout documents; of equal ones the loosest.  A stratum whose holdout is too
small to certify a step that catches anything uses no rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

# Rejecting is signal > cutoff; cutoffs from loose to strict.
RULES = {
    "symbol_share": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01],
    "shout_share": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
    "repeat_share": [0.49, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05],
    "word_length": [40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 9.0, 8.0],
}
ALPHA, DELTA = 0.025, 0.05
BROADCAST_STRATA = 50_000  # rows


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Windows are sorted with their positions and compared with their neighbours;
    texts whose windows all differ (by hash) skip that.  Words hold no space, so the
    space-joined window is exact."""
    at = F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1)))
    windows = F.transform(at, lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    hashes = F.transform(at, lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    ranked = F.sort_array(F.arrays_zip(windows.alias("w"), at.alias("i")))

    def twice(rows: Column) -> Column:
        k = F.sequence(F.lit(0), F.size(rows) - 1)
        here = F.filter(k, lambda j: (F.get(rows, j)["w"] == F.get(rows, j - 1)["w"])
                        | (F.get(rows, j)["w"] == F.get(rows, j + 1)["w"]))
        place = F.transform(here, lambda j: F.get(rows, j)["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(place, lambda i: F.array(i, i + 1, i + 2)))))

    # element_at of a one-element transform binds the sorted array once
    counted = F.element_at(F.transform(F.array(ranked), twice), 1)
    some = F.size(F.array_distinct(hashes)) < n - 2
    return F.when((n >= 4) & some, counted).otherwise(F.lit(0))


def signals(docs: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str | None = "lang") -> DataFrame:
    """(_id, _stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    and the rules' signals) per row.  Null and wordless texts: zeros; a null
    stratum is a stratum of its own ('')."""
    s = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit("")
    base = docs.select(F.col(id_col).alias("_id"), s.alias("_stratum"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    cut = base.select("_id", "_stratum", "_t", _words(F.col("_t")).alias("_w"),
                      F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    n = F.size("_w")
    out = cut.select(
        "_id", "_stratum", n.cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.regexp_replace("_t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_w"), n).cast("long").alias("n_repeat_words"),
        F.size("_l").alias("_lines"),
        (F.char_length("_t") - F.char_length(F.regexp_replace("_t", r"[A-Z!]+", ""))).alias("_shout"))
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return out.select(
        "_id", "_stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("n_symbols") / chars).alias("symbol_share"), (F.col("_shout") / chars).alias("shout_share"),
        (F.col("n_dup_lines") / F.greatest("_lines", F.lit(1))).alias("dup_line_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"), (F.col("word_chars") / words).alias("word_length"))


def binomial_tail(x: Column, n: Column, p: float) -> Column:
    """Logarithm of P(Bin(n, p) <= x), summed exactly term by term in logarithms.
    Above the mean the tail is over one half; 0 stands for it there."""
    first = n * F.log(F.lit(1 - p))
    odds = F.log(F.lit(p / (1 - p)))

    def step(acc: Column, i: Column) -> Column:
        term = acc["t"] + F.log((n - i + 1) / i) + odds
        high = F.greatest(acc["s"], term)
        return F.struct(term.alias("t"), (high + F.log(F.exp(acc["s"] - high) + F.exp(term - high))).alias("s"))

    summed = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(x, F.lit(1).cast("long"))),
                         F.struct(first.alias("t"), first.alias("s")), step, lambda a: a["s"])
    return F.when(x == 0, first).when(x > n * p, F.lit(0.0)).otherwise(summed)


def path(rules: dict[str, list[float]]) -> list[tuple[str, float]]:
    """The fixed sequence of (rule, cutoff): all rules' loosest cutoffs in the order of
    ``rules``, then their next ones, and so on."""
    return [(r, float(cs[i])) for i in range(max(map(len, rules.values()), default=0)) for r, cs in rules.items() if i < len(cs)]


def reached_step(rules: dict[str, list[float]]) -> Column:
    """The first step of the path that rejects a row; null if none does."""
    place = {rc: k for k, rc in enumerate(path(rules))}
    firsts = []
    for r, cs in rules.items():
        first = F
        for c in cs:                                           # loosest first
            first = first.when(F.col(r) > float(c), place[r, float(c)])
        firsts.append(first)
    return F.array_min(F.array(*firsts))


def steps(sig: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", rules: dict | None = None,
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(_stratum, step, n, x, caught): the certified step of the path used for each
    stratum.  Null and contradicting labels are left out; a repeated label
    or document row of an id counts as often as the document occurs."""
    rules = rules or RULES
    one = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("_id")) \
        .agg(F.min(label).alias("_y"), F.max(label).alias("_y2")).where(F.col("_y") == F.col("_y2")).select("_id", "_y")
    never = len(path(rules))
    held = sig.join(one, "_id").select("_stratum", "_y", F.coalesce(reached_step(rules), F.lit(never)).alias("step"))
    # a row per stratum and step: the steps in between reject what the one before them rejects
    here = cut_lineage(held.groupBy("_stratum", "step").agg(F.sum("_y").cast("long").alias("good"),
                                                            F.sum(1 - F.col("_y")).cast("long").alias("bad")))
    strata = here.agg(F.count_distinct("_stratum")).scalar()
    log_level = F.log(F.lit(delta)) - F.log(strata)
    all_steps = Window.partitionBy("_stratum")
    upto = all_steps.orderBy("step")                           # at most as many rows as the path has steps
    tested = here.select("_stratum", "step", F.sum("good").over(all_steps).alias("n"), F.sum("good").over(upto).alias("x"),
                         F.sum("bad").over(upto).alias("caught"))
    ok = (F.col("n") > 0) & (binomial_tail(F.col("x"), F.col("n"), alpha) <= log_level)
    passed = tested.withColumn("ok", F.min(ok).over(upto)).where(F.col("ok") & (F.col("step") < never) & (F.col("caught") > 0))
    gain = F.col("caught") - F.col("x")
    best = passed.groupBy("_stratum").agg(F.max_by(F.struct("step", "n", "x", "caught"), F.struct(gain, -F.col("step"))).alias("b"))
    return best.select("_stratum", "b.*")


def cutoffs(sig: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", rules: dict | None = None,
            alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(_stratum, rule, cutoff, n, x, caught): the cutoffs in use, one row per stratum and
    rule; n, x and caught are those of the stratum's joint verdict."""
    rules = rules or RULES
    used = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(r).alias("rule"), F.lit(c).alias("cutoff"))
                               for k, (r, c) in enumerate(path(rules))]))
    got = steps(sig, labels, id_col, label, rules, alpha, delta)
    return got.select("*", used.alias("u")).where(F.col("u.k") <= F.col("step")).groupBy("_stratum", "u.rule").agg(
        F.min("u.cutoff").alias("cutoff"), F.max("n").alias("n"), F.max("x").alias("x"), F.max("caught").alias("caught"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str | None = "lang",
          label: str = "quality", min_words: int = 50, max_repeat_percent: int = 50, alpha: float = ALPHA,
          delta: float = DELTA, rules: dict | None = None) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    base_failed: fewer than ``min_words`` words, or over ``max_repeat_percent`` of
    the words in repeated 3-word windows.  kept: not base_failed and no
    signal above the cutoffs of its stratum's certified step, which is chosen on the labelled
    rows that pass the base rule: of the good ones among them at most alpha are lost.  Null and empty texts fail the base
    rule; repeated rows are judged each; without labels only the base rule
    decides; columns beside id, text and stratum are not read."""
    rules = rules or RULES
    sig = cut_lineage(signals(docs, id_col, text, stratum))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    per = cut_lineage(steps(sig.where(~failed), labels, id_col, label, rules, alpha, delta).select("_stratum", F.col("step").alias("_upto")))
    if per.count() <= BROADCAST_STRATA:      # else an ordinary join, whose hot strata can be split
        per = F.broadcast(per)
    verdict = F.coalesce(reached_step(rules) > F.col("_upto"), F.lit(True))
    j = sig.join(per, "_stratum", "left")
    return j.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & verdict).alias("kept"))
