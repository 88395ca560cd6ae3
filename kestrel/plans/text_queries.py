"""Text features (survey 2.11, SQL-checked part) over the whole documents
table, and the spark.ml model family (rows-checked)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import text as X
from kestrel.plans.registry import query
from kestrel.sources.tables import load

_TOK_LOWER = r"[\p{L}\p{N}_]{2,}"
_TOK_RAW = r"[\p{L}\p{N}_]+"

_TF = f"""WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '{_TOK_LOWER}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term HAVING count(*) >= 2),
vocab AS (SELECT term, df, cf, row_number() OVER (ORDER BY cf DESC, term) - 1 AS term_idx FROM st),
nd AS (SELECT count(*) AS n FROM documents)
"""


def _vocabulary(docs):
    return X.vocabulary(X.term_stats(docs, "text"))


def _tf(spark, sf):
    docs = load(spark, sf, "documents")
    # no rank of the vocabulary: none of the weight queries returns it
    # texts are dealt by id before they are cut, so that counting (id, term) moves no tokens
    dealt = docs.select("doc_id", "text").repartition("doc_id")
    return docs, X.term_counts(X.tokens(dealt, "doc_id", "text"), "doc_id"), X.doc_freq(docs, "text").where(F.col("df") >= 2)


@query("text_tokenize", sql=f"""
SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '{_TOK_RAW}')) AS BIGINT) AS n_tokens,
       CAST(len(regexp_extract_all(lower(coalesce(text, '')), '{_TOK_LOWER}')) AS BIGINT) AS n_tokens_lower2 FROM documents""")
def text_tokenize(spark, sf):
    """Word tokens (Unicode word characters), raw and lowercased >= 2 chars."""
    d = load(spark, sf, "documents")
    t = F.coalesce(F.col("text"), F.lit(""))
    return d.select("doc_id", F.size(F.regexp_extract_all(t, F.lit(_TOK_RAW), 0)).cast("bigint").alias("n_tokens"),
                    F.size(F.regexp_extract_all(F.lower(t), F.lit(_TOK_LOWER), 0)).cast("bigint").alias("n_tokens_lower2"))


@query("text_doc_freq", sql=_TF + "SELECT term, df, CAST(cf AS BIGINT) AS cf, term_idx FROM vocab", bench=True)
def text_doc_freq(spark, sf):
    """Document and corpus frequency of every term in two documents or more."""
    return _vocabulary(load(spark, sf, "documents")).select("term", "df", "cf", "term_idx")


@query("text_count", sql=_TF + "SELECT tf.doc_id, tf.term, CAST(tf.tf AS DOUBLE) AS w FROM tf JOIN vocab USING (term)")
def text_count(spark, sf):
    docs, tf, v = _tf(spark, sf)
    return X.weights(tf, v, "doc_id", None, "count").select("doc_id", "term", "w")


@query("text_tf_l2", rnd=["w"], sql=_TF + """
, j AS (SELECT tf.doc_id, tf.term, tf.tf FROM tf JOIN vocab USING (term)),
nm AS (SELECT doc_id, sqrt(sum(tf * tf)) AS nrm FROM j GROUP BY doc_id)
SELECT doc_id, term, tf / nrm AS w FROM j JOIN nm USING (doc_id)""")
def text_tf_l2(spark, sf):
    docs, tf, v = _tf(spark, sf)
    return X.weights(tf, v, "doc_id", None, "tf_l2").select("doc_id", "term", "w")


@query("text_tfidf", rnd=["w"], bench=True, sql=_TF + """
, j AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1 + nd.n) / (1 + vocab.df)) + 1) AS raw FROM tf JOIN vocab USING (term) CROSS JOIN nd),
nm AS (SELECT doc_id, sqrt(sum(raw * raw)) AS nrm FROM j GROUP BY doc_id)
SELECT doc_id, term, raw / nrm AS w FROM j JOIN nm USING (doc_id)""")
def text_tfidf(spark, sf):
    """Smoothed idf ln((1+n)/(1+df)) + 1, L2 per document (S12)."""
    docs, tf, v = _tf(spark, sf)
    nd = docs.agg(F.count(F.lit(1)).alias("n"))
    return X.weights(tf, v, "doc_id", nd, "tfidf").select("doc_id", "term", "w")


@query("text_dtm_sparse_prune", sql=f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '{_TOK_LOWER}')) AS term FROM documents),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM tok WHERE NOT regexp_matches(term, '^[0-9]+$') GROUP BY term)
SELECT term, df FROM df WHERE df >= 0.005 * (SELECT count(*) FROM documents)""")
def text_dtm_sparse_prune(spark, sf):
    """Drop numeric terms, prune terms in under 0.5 % of documents."""
    docs = load(spark, sf, "documents")
    tok = X.tokens(docs, "doc_id", "text").where(~F.col("term").rlike("^[0-9]+$"))
    df = tok.groupBy("term").agg(F.countDistinct("doc_id").alias("df"))
    from kestrel.functions import scalar
    n_min = scalar(docs.agg((F.count(F.lit(1)) * 0.005).alias("_min")))
    return df.where(F.col("df") >= n_min).select("term", "df")
