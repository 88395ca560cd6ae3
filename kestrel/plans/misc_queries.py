"""Sorts, set operations, reshaping, JSON, grouped Python (survey 2.13) and
sources / sinks (2.1).  File sources read files that Spark first writes from
the given tables into the shared checkpoint folder, so their work grows with
the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kestrel.plans.registry import query
from kestrel.plans.sqlbind import DID, LABELS_LONG, PANEL_M, TAXONOMY, with_
from kestrel.session import ensure_checkpoint_dir
from kestrel.sources import bindings as B
from kestrel.sources import files as FS
from kestrel.sources.tables import load
import kestrel.plans.eval_queries  # noqa: F401,E402  (oracle text reused by the CSV sink)


def _ORACLE_OF(name: str) -> str:
    from kestrel.plans.registry import ORACLE
    return ORACLE[name]


@query("sort_multi_key", sql="""
SELECT c_nationkey, c_mktsegment, c_custkey, c_acctbal FROM customer ORDER BY c_nationkey ASC, c_acctbal DESC, c_custkey""")
def sort_multi_key(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_nationkey", "c_mktsegment", "c_custkey", "c_acctbal").orderBy(
        F.col("c_nationkey").asc(), F.col("c_acctbal").desc(), "c_custkey")


@query("set_union_all", sql="""
SELECT doc_id AS id, 'document' AS kind FROM documents UNION ALL SELECT item_id, 'benchmark' FROM benchmark""")
def set_union_all(spark, sf):
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"))
    b = load(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.lit("benchmark").alias("kind"))
    return d.unionByName(b)


@query("set_union_distinct", sql="SELECT doc_id AS id FROM documents UNION SELECT doc_id FROM labels")
def set_union_distinct(spark, sf):
    return (load(spark, sf, "documents").select(F.col("doc_id").alias("id"))
            .union(load(spark, sf, "labels").select(F.col("doc_id").alias("id"))).distinct())


@query("set_intersect", sql="SELECT o_custkey AS id FROM orders INTERSECT SELECT c_custkey FROM customer")
def set_intersect(spark, sf):
    o = load(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    return o.intersect(load(spark, sf, "customer").select(F.col("c_custkey").alias("id")))


@query("set_except", sql="SELECT doc_id AS id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_except(spark, sf):
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return d.subtract(load(spark, sf, "labels").select(F.col("doc_id").alias("id")))


# The return flags pivoted into columns.
FLAGS = ["A", "N", "R"]


@query("reshape_pivot", rnd=[f"px_{f}" for f in FLAGS], sql="""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS d, """ + ", ".join(
    f"avg(CASE WHEN l_returnflag = '{f}' THEN l_extendedprice END) AS px_{f}" for f in FLAGS) + """ FROM lineitem GROUP BY 1""")
def reshape_pivot(spark, sf):
    """Long -> wide with an explicit value list (no discovery pass)."""
    li = load(spark, sf, "lineitem")
    p = li.groupBy(B.month_of("l_shipdate").alias("d")).pivot("l_returnflag", FLAGS).agg(F.avg("l_extendedprice"))
    return p.select("d", *[F.col(f).alias(f"px_{f}") for f in FLAGS])


@query("reshape_stack", rnd=["value"], sql=with_(PANEL_M) + """
SELECT id, d, measure, value FROM (UNPIVOT panel_m ON price, vol INTO NAME measure VALUE value) AS _u WHERE value IS NOT NULL""")
def reshape_stack(spark, sf):
    """Wide -> long, NULLs dropped."""
    m = B.panel_monthly(spark, sf)
    return m.unpivot(["id", "d"], ["price", "vol"], "measure", "value").where(F.col("value").isNotNull())


@query("json_roundtrip", sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       to_json({'event_type': event_type, 'k': CAST(json_extract(props, '$.k') AS BIGINT)}) AS out_json FROM events""")
def json_roundtrip(spark, sf):
    """Parse a JSON column with a schema, rebuild JSON from a struct."""
    e = load(spark, sf, "events")
    parsed = e.select("event_id", "event_type", F.from_json("props", "k BIGINT").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"),
                         F.to_json(F.struct("event_type", F.col("p.k").alias("k"))).alias("out_json"))


@query("udf_grouped_apply", rnd=["max_drawup"], dp=4, sql=with_(PANEL_M) + """
, dd AS (SELECT id, price / min(price) OVER (PARTITION BY id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS up
        FROM panel_m)
SELECT id, count(*) AS n, max(up) AS max_drawup FROM dd GROUP BY id""")
def udf_grouped_apply(spark, sf):
    """Arbitrary Python per entity: groupBy(id).applyInPandas on the (id, month)
    grain -- each group is one supplier's monthly series (calendar-bounded)."""
    import pandas as pd

    def per_id(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("d")["price"].to_numpy(float)
        trough = pd.Series(p).cummin().to_numpy()
        return pd.DataFrame({"id": [pdf["id"].iloc[0]], "n": [len(p)], "max_drawup": [float((p / trough - 1).max())]})
    m = B.panel_monthly(spark, sf).select("id", "d", "price")
    return m.groupBy("id").applyInPandas(per_id, "id long, n long, max_drawup double")


# ------------------------------------------------------- sources / sinks ----
def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex}"


@query("src_csv_quoted", rnd=["ret"])
def src_csv_quoted(spark, sf):
    """Quoted CSV with embedded quotes, CRLF, scientific notation and empty
    fields, written from lineitem, read back with a schema and coerced."""
    path = _scratch(spark, "panel_csv")
    FS.write_panel_csv(B.panel_daily_raw(spark, sf), path)
    return FS.read_panel_csv(spark, path)


@query("src_whitespace_positional", sql="WITH " + DID + " SELECT store, nj, chain, co_owned, fte, fte2, gap, closed FROM did")
def src_whitespace_positional(spark, sf):
    """Headerless whitespace-separated file, '.' as missing, columns by position,
    coerced to their types."""
    path = _scratch(spark, "survey_txt")
    FS.write_whitespace(B.did_stores(spark, sf), path)
    return FS.read_whitespace(spark, path, "store long, nj int, chain string, co_owned int, fte double, fte2 double, "
                                           "gap double, closed int")


@query("src_taxonomy_csv", sql=with_(TAXONOMY) + """
, e AS (SELECT parent, child, row_number() OVER (ORDER BY parent, child) AS id_cat FROM edges)
SELECT CAST(id_cat AS INTEGER) AS id_cat, parent, child,
       CASE WHEN id_cat % 10 = 0 THEN '' ELSE 'node ' || child || ', level, and more' END AS description FROM e
UNION ALL SELECT 0, 'None', 'Root', 'root node, top'""")
def src_taxonomy_csv(spark, sf):
    """4-field taxonomy lines whose last field carries unquoted commas; short
    lines padded; blank / None parents kept for tree_load to drop."""
    path = _scratch(spark, "taxonomy")
    FS.write_taxonomy(B.taxonomy_edges(spark, sf), path)
    return FS.read_taxonomy(spark, path)


@query("src_header_dates_unpivot", rnd=["y"], dp=2, sql=with_(PANEL_M) + """
SELECT id AS region, d AS t, price AS y FROM panel_m WHERE price IS NOT NULL""")
def src_header_dates_unpivot(spark, sf):
    """A wide file with one row per region and months as headers -> (region, t, y) for all
    regions; which columns are months is found in the header."""
    path = _scratch(spark, "wide_csv")
    FS.write_wide_dates(B.panel_monthly(spark, sf).withColumnRenamed("id", "region"), "region", "d", "price", path)
    return FS.read_wide_dates(spark, path).withColumn("region", F.col("region").cast("bigint"))


@query("src_chunked_filtered", sql=with_(LABELS_LONG) + """
SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT id FROM labels_long WHERE cat = 'en')""")
def src_chunked_filtered(spark, sf):
    """Partition-parallel scan of a projected column set, restricted to a pool
    of ids with a left-semi join (pruning + pushdown do the chunking)."""
    pool = B.labels_long(spark, sf).where(F.col("cat") == "en").select(F.col("id").alias("doc_id"))
    return load(spark, sf, "documents").select("doc_id", "n_chars").join(pool, "doc_id", "left_semi")


@query("src_regional_filter", sql="""
SELECT o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_nationkey = 3 AND c_mktsegment = 'BUILDING' AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def src_regional_filter(spark, sf):
    """Equality filters on several keys (pushed to the scans)."""
    o = load(spark, sf, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    c = load(spark, sf, "customer").where((F.col("c_nationkey") == 3) & (F.col("c_mktsegment") == "BUILDING"))
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_totalprice")


@query("sink_jsonl_scores", sql="""
WITH s AS (SELECT 'quality' AS label, l.doc_id AS id, l.quality AS y, ((l.doc_id * 37 + d.n_chars) % 1000) / 1000.0 AS score
           FROM labels l JOIN documents d USING (doc_id)
           UNION ALL
           SELECT 'toxic', l.doc_id, l.toxic, ((l.doc_id * 53 + d.n_chars * 7) % 1000) / 1000.0 FROM labels l JOIN documents d USING (doc_id))
SELECT label, id, y, score, CAST(score >= 0.5 AS INTEGER) AS pred,
       CASE WHEN (id * 7919) % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM s""")
def sink_jsonl_scores(spark, sf):
    """Score the corpus and write JSON lines with a split tag; read back."""
    from kestrel.plans.eval_queries import scores
    path = _scratch(spark, "scores_jsonl")
    s = scores(spark, sf).withColumn("split", F.when((F.col("id") % 100 * 7919) % 100 < 80, "train").otherwise("test"))
    s.write.mode("overwrite").json(path)
    return spark.read.schema(s.schema).json(path)


@query("sink_manifest", sql="""
SELECT count(*) AS n_articles, count(DISTINCT lang) AS n_langs, CAST(sum(n_chars) AS BIGINT) AS n_chars, 'documents' AS corpus
FROM documents""")
def sink_manifest(spark, sf):
    """One-row manifest of a corpus build, written as JSON and read back."""
    path = _scratch(spark, "manifest")
    d = load(spark, sf, "documents")
    man = d.agg(F.count(F.lit(1)).alias("n_articles"), F.countDistinct("lang").alias("n_langs"),
                F.sum("n_chars").alias("n_chars")).withColumn("corpus", F.lit("documents"))
    man.coalesce(1).write.mode("overwrite").json(path)   # a single one-row file
    return spark.read.schema("n_articles long, n_langs long, n_chars long, corpus string").json(path)


@query("sink_result_csv", sql=_ORACLE_OF("eval_binary"))
def sink_result_csv(spark, sf):
    """Write a metric table as CSV with a header and read it back."""
    from kestrel.plans.eval_queries import eval_binary
    path = _scratch(spark, "metrics_csv")
    m = eval_binary(spark, sf)
    m.write.mode("overwrite").option("header", True).csv(path)
    return spark.read.option("header", True).schema(m.schema).csv(path)


# ------------------------------------------------------------ streaming -----
_TOKENS = r"""tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}')) AS term FROM documents)"""


@query("stream_score_files", rnd=["score"], sql=f"""
WITH {_TOKENS},
coef AS (SELECT term, sum(2 * quality - 1) / count(*) AS weight FROM tok JOIN labels USING (doc_id) GROUP BY term),
s AS (SELECT doc_id, sum(weight) AS score FROM tok JOIN coef USING (term) GROUP BY doc_id)
SELECT doc_id, coalesce(score, 0.0) AS score, CASE WHEN (doc_id * 7919) % 100 < 80 THEN 'train' ELSE 'test' END AS split
FROM documents LEFT JOIN s USING (doc_id)""")
def stream_score_files(spark, sf):
    """Scoring re-aimed as a file stream with a checkpoint; the model is the whole
    (term, weight) table of the labelled corpus, stored once before the stream starts."""
    from kestrel.operators import text as X
    from kestrel.session import cut_lineage
    from kestrel.streaming.jobs import score_files
    docs = load(spark, sf, "documents").select("doc_id", "text")
    base = _scratch(spark, "stream_score")
    docs.write.parquet(f"{base}/in")
    lab = load(spark, sf, "labels").select("doc_id", (F.col("quality") * 2 - 1).alias("t"))
    tok = X.tokens(docs.join(lab, "doc_id").select(F.struct("doc_id", "t").alias("d"), "text"), "d", "text")
    coef = cut_lineage(tok.groupBy("term").agg((F.sum("d.t") / F.count(F.lit(1))).alias("weight")))
    score_files(spark, f"{base}/in", docs.schema, coef, f"{base}/out", f"{base}/ckpt")
    return spark.read.schema("doc_id long, score double, split string").json(f"{base}/out").select("doc_id", "score", "split")


@query("stream_corpus_ingest", sql="""
SELECT conv_id AS id, turn, role FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) = 1""")
def stream_corpus_ingest(spark, sf):
    """Corpus append with ids already stored dropped (streaming dedup): of each
    conversation the first turn is stored."""
    from kestrel.streaming.jobs import ingest_dedup
    rows = load(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "turn", "role")
    base = _scratch(spark, "stream_ingest")
    rows.write.parquet(f"{base}/in")
    ingest_dedup(spark, f"{base}/in", rows.schema, f"{base}/out", f"{base}/ckpt", "id", ["turn", "role"])
    return spark.read.schema(rows.schema).parquet(f"{base}/out").select("id", "turn", "role")
