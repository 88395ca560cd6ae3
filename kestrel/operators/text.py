"""Text features as joins and aggregations over (doc, term) rows.

Tokens are extracted JVM-side (``regexp_extract_all``), term statistics are
``groupBy`` aggregates with map-side combine.  The vocabulary holds every term
above the document-frequency minimum (``max_features`` is an option, off by
default), is ranked by range partitions and joined, never broadcast; TF-IDF weights
are normalised per document in the shuffle by document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Token patterns (Unicode word characters; lowercase variant keeps 2+ chars).
TOKEN_RAW = r"[\p{L}\p{N}_]+"
TOKEN_LOWER2 = r"[\p{L}\p{N}_]{2,}"


def tokens(docs: DataFrame, id_col: str, text: str, lower: bool = True) -> DataFrame:
    """(id, term) one row per token occurrence."""
    src = F.lower(F.col(text)) if lower else F.col(text)
    pat = TOKEN_LOWER2 if lower else TOKEN_RAW
    return docs.select(id_col, F.explode(F.regexp_extract_all(F.coalesce(src, F.lit("")), F.lit(pat), 0)).alias("term"))


def row_counts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, term, tf), counted inside each row over its sorted tokens: no shuffle."""
    t = F.sort_array(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN_LOWER2), 0))
    run = F.filter(F.transform("_t", lambda x, i: F.when((i == 0) | (x != F.get("_t", i - 1)), i)), lambda i: i.isNotNull())
    pairs = F.transform("_s", lambda i, k: F.struct(F.get("_t", i).alias("term"),
                                                    (F.coalesce(F.get("_s", k + 1), F.size("_t")) - i).cast("bigint").alias("tf")))
    return (docs.select(F.col(id_col), t.alias("_t")).withColumn("_s", run)
            .select(id_col, F.explode(pairs).alias("_x")).select(id_col, "_x.term", "_x.tf"))


def term_counts(tok: DataFrame, id_col: str) -> DataFrame:
    return tok.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def doc_freq(docs: DataFrame, text: str) -> DataFrame:
    """(term, df): texts that hold a term."""
    t = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN_LOWER2), 0))
    return docs.select(F.explode(t).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def term_stats(docs: DataFrame, text: str) -> DataFrame:
    """(term, df, cf) in one aggregation by term: the tokens of a text are sorted
    in its row, so each one knows whether it is its text's first of that term."""
    t = F.sort_array(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN_LOWER2), 0))
    row = docs.select(t.alias("_t"))
    first = F.transform("_t", lambda x, i: F.struct(x.alias("term"), F.when((i > 0) & (x == F.get("_t", i - 1)), 0).otherwise(1).alias("new")))
    return row.select(F.explode(first).alias("x")).groupBy(F.col("x.term").alias("term")) \
        .agg(F.sum("x.new").cast("bigint").alias("df"), F.count(F.lit(1)).alias("cf"))


def vocabulary(stats: DataFrame, min_df: int = 2, max_features: int | None = None) -> DataFrame:
    """(term, df, cf, term_idx): terms in >= min_df docs by corpus frequency (ties
    by term), all of them unless ``max_features`` is given.  Ranks are running counts
    over range partitions, so no task sorts the whole vocabulary."""
    from kestrel.operators.evaluate import running_totals
    st = stats.where(F.col("df") >= min_df)
    if max_features is not None:
        st = st.orderBy(F.col("cf").desc(), "term").limit(max_features)
    st = st.withColumn("_k", F.struct((-F.col("cf")).alias("c"), "term")).withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_totals(st, [], "_k", ["one"], descending=False)
    return ranked.select("term", "df", "cf", (F.col("cum_one") - 1).alias("term_idx"))


def weights(tf: DataFrame, vocab: DataFrame, id_col: str, n_docs: DataFrame, scheme: str = "tfidf") -> DataFrame:
    """(id, term, term_idx, w) with scheme 'count' | 'tf_l2' | 'tfidf'
    (smoothed idf = ln((1+n)/(1+df)) + 1, then L2 per document).  ``vocab``: (term, df, term_idx); term_idx
    is null if it is not ranked."""
    if "term_idx" not in vocab.columns:
        vocab = vocab.withColumn("term_idx", F.lit(None).cast("bigint"))
    # the side of the vocabulary is hashed, so that the rows of the texts need no sort by term
    j = tf.join(vocab.select("term", "term_idx", "df").hint("shuffle_hash"), "term")
    if scheme == "count":
        return j.select(id_col, "term", "term_idx", F.col("tf").cast("double").alias("w"))
    if scheme == "tfidf":
        from kestrel.functions import scalar
        n = scalar(n_docs)                       # corpus size as a scalar subquery
        raw = F.col("tf") * (F.log((1 + n) / (1 + F.col("df"))) + 1)
    else:
        raw = F.col("tf").cast("double")
    j = j.withColumn("_raw", raw)
    # a document's terms meet once: the norm is a window over its own rows
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(id_col)))
    return j.select(id_col, "term", "term_idx", (F.col("_raw") / norm).alias("w"))
