"""Hierarchy & corpus engineering (survey 2.10), label joins (2.4) and label
aggregates (2.5) over the document taxonomy Root -> lang -> lang/source."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel import functions as K
from kestrel.operators import corpus as C
from kestrel.operators import topdown as TD
from kestrel.operators import tree as T
from kestrel.plans.registry import query
from kestrel.plans.sqlbind import CLOSURE, LABELS_LONG, TAXONOMY, with_, with_rec
from kestrel.sources import bindings as B
from kestrel.sources.tables import load

_TREE = with_rec(TAXONOMY, CLOSURE)
_TL = with_rec(TAXONOMY, CLOSURE, LABELS_LONG)


def _edges(spark, sf):
    """The cleaned edge table, materialised once in the shared checkpoint
    folder: it is taxonomy-sized, and every closure level re-reads it, so
    cutting its lineage keeps the corpus scan from repeating per level."""
    from kestrel.session import cut_lineage
    return cut_lineage(T.clean_edges(B.taxonomy_edges(spark, sf)))


@query("tree_load", sql=with_(TAXONOMY) + "SELECT DISTINCT parent, child FROM edges")
def tree_load(spark, sf):
    """Taxonomy lines written from the tables, parsed (unquoted commas in the
    description, short lines, a 'None' parent) and cleaned into edges."""
    import uuid
    from kestrel.session import ensure_checkpoint_dir
    from kestrel.sources import files as FS
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/taxonomy-{uuid.uuid4().hex}"
    FS.write_taxonomy(B.taxonomy_edges(spark, sf), path)
    return T.clean_edges(FS.read_taxonomy(spark, path))


@query("tree_leaves", sql=_TREE + "SELECT node FROM nodes WHERE node NOT IN (SELECT parent FROM edges)")
def tree_leaves(spark, sf):
    return T.leaves(_edges(spark, sf))


@query("tree_branching", sql=_TREE + "SELECT parent, count(*) AS n_children FROM edges GROUP BY parent HAVING count(*) >= 2")
def tree_branching(spark, sf):
    return T.branching(_edges(spark, sf))


@query("tree_depth", sql=_TREE + "SELECT node, depth FROM depth")
def tree_depth(spark, sf):
    return T.depth(_edges(spark, sf))


@query("tree_edge_specs", sql=_TREE + """
SELECT e.parent, e.child, d.depth FROM edges e JOIN depth d ON d.node = e.parent
WHERE e.parent IN (SELECT parent FROM edges GROUP BY parent HAVING count(*) >= 2)""")
def tree_edge_specs(spark, sf):
    return T.edge_specs(_edges(spark, sf))


@query("tree_closure", sql=_TREE + "SELECT ancestor, descendant, dist FROM closure")
def tree_closure(spark, sf):
    return T.closure(_edges(spark, sf))


@query("tree_path", sql=_TREE + """
SELECT c.descendant AS node, string_agg(c.ancestor, '>' ORDER BY d.depth) AS path
FROM closure c JOIN depth d ON d.node = c.ancestor GROUP BY c.descendant""")
def tree_path(spark, sf):
    return T.paths(_edges(spark, sf))


@query("tree_summary", sql=_TREE + """
, cc AS (SELECT parent, count(*) AS n FROM edges GROUP BY parent)
SELECT 'nodes' AS metric, count(*) AS v FROM nodes
UNION ALL SELECT 'leaves', count(*) FROM nodes WHERE node NOT IN (SELECT parent FROM edges)
UNION ALL SELECT 'branching', count(*) FROM cc WHERE n >= 2
UNION ALL SELECT 'edges', count(*) FROM edges
UNION ALL SELECT 'max_branching', max(n) FROM cc
UNION ALL SELECT 'max_depth', CAST(max(depth) AS BIGINT) FROM depth""")
def tree_summary(spark, sf):
    return T.summary(_edges(spark, sf))


def _labels(spark, sf):
    return B.labels_long(spark, sf)


def _labels_mat(spark, sf):
    """Long labels materialised once for queries that join them repeatedly."""
    from kestrel.session import cut_lineage
    return cut_lineage(B.labels_long(spark, sf))


@query("label_level_tag", sql=_TL + "SELECT l.id, l.cat, d.depth AS level FROM labels_long l JOIN depth d ON d.node = l.cat")
def label_level_tag(spark, sf):
    """Category -> level through the (small) depth table."""
    dep = T.depth(_edges(spark, sf))
    return _labels(spark, sf).join(dep.select(F.col("node").alias("cat"), F.col("depth").alias("level")), "cat") \
        .select("id", "cat", "level")


_PRIMARY = _TL + """
, ld AS (SELECT l.id, l.cat, d.depth FROM labels_long l JOIN depth d ON d.node = l.cat),
prim AS (SELECT id, cat, depth FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY depth DESC, cat) AS r FROM ld) AS _x
         WHERE r = 1)
"""


@query("label_deepest", sql=_TL + """
, ld AS (SELECT l.id, l.cat, d.depth FROM labels_long l JOIN depth d ON d.node = l.cat)
SELECT id, cat, depth FROM ld WHERE depth = (SELECT max(depth) FROM ld l2 WHERE l2.id = ld.id)""")
def label_deepest(spark, sf):
    """All labels at each document's maximum depth (max over id, no self-join)."""
    dep = T.depth(_edges(spark, sf))
    j = _labels(spark, sf).join(dep.select(F.col("node").alias("cat"), "depth"), "cat")
    j = j.withColumn("_m", F.max("depth").over(Window.partitionBy("id")))
    return j.where(F.col("depth") == F.col("_m")).select("id", "cat", "depth")


@query("label_primary", sql=_PRIMARY + "SELECT id, cat, depth FROM prim")
def label_primary(spark, sf):
    return T.deepest_label(_labels(spark, sf), T.depth(_edges(spark, sf))).select("id", "cat", "depth")


@query("join_max_back", sql=_TL + """
, ld AS (SELECT l.id, l.cat, d.depth FROM labels_long l JOIN depth d ON d.node = l.cat)
SELECT id, count(*) AS n_at_max FROM ld WHERE depth = (SELECT max(depth) FROM ld l2 WHERE l2.id = ld.id) GROUP BY id""")
def join_max_back(spark, sf):
    return label_deepest(spark, sf).groupBy("id").agg(F.count(F.lit(1)).alias("n_at_max"))


@query("label_leaf_status", sql=_TL + """
, lv AS (SELECT node FROM nodes WHERE node NOT IN (SELECT parent FROM edges)),
st AS (SELECT l.id, bool_or(l.cat IN (SELECT node FROM lv)) AS has_leaf, bool_or(l.cat IN (SELECT node FROM nodes)) AS in_tree
       FROM labels_long l GROUP BY l.id)
SELECT CASE WHEN has_leaf THEN 'has_leaf' WHEN in_tree THEN 'parent_only' ELSE 'not_in_tree' END AS status,
       count(*) AS n FROM st GROUP BY 1""")
def label_leaf_status(spark, sf):
    """has_leaf / parent_only / not_in_tree per article, counted."""
    e = _edges(spark, sf)
    lv = T.leaves(e).select(F.col("node").alias("cat"), F.lit(True).alias("is_leaf"))
    nd = T.nodes(e).select(F.col("node").alias("cat"), F.lit(True).alias("in_tree_"))
    j = _labels(spark, sf).join(lv, "cat", "left").join(nd, "cat", "left")
    st = j.groupBy("id").agg(F.bool_or(F.coalesce("is_leaf", F.lit(False))).alias("has_leaf"),
                             F.bool_or(F.coalesce("in_tree_", F.lit(False))).alias("in_tree"))
    s = F.when(F.col("has_leaf"), "has_leaf").when(F.col("in_tree"), "parent_only").otherwise("not_in_tree")
    return st.groupBy(s.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("label_matrix", sql=with_(LABELS_LONG) + """
, dict AS (SELECT cat, row_number() OVER (ORDER BY cat) - 1 AS idx FROM (SELECT DISTINCT cat FROM labels_long) AS _c),
own AS (SELECT id, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices
        FROM (SELECT DISTINCT l.id, idx FROM labels_long l JOIN dict USING (cat)) AS _o GROUP BY id)
SELECT d.doc_id AS id, coalesce(indices, '') AS indices, (SELECT count(*) FROM dict) AS n_columns
FROM documents d LEFT JOIN own ON own.id = d.doc_id""")
def label_matrix(spark, sf):
    """Multilabel indicator over all labels of the data: the columns that are 1 in each
    document's row, comma-joined; every other one is 0."""
    lab = _labels_mat(spark, sf)
    dictionary = C.label_dictionary(lab)
    out = C.label_vectors(load(spark, sf, "documents").select(F.col("doc_id").alias("id")), lab, dictionary)
    return out.select("id", F.array_join("indices", ",").alias("indices"),
                      K.scalar(dictionary.agg(F.count(F.lit(1)).alias("n"))).alias("n_columns"))


@query("join_left_labels", sql=with_(LABELS_LONG) + """
SELECT d.doc_id AS id, CAST(count(l.cat) AS BIGINT) AS n_labels FROM documents d LEFT JOIN labels_long l ON l.id = d.doc_id
GROUP BY d.doc_id""")
def join_left_labels(spark, sf):
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return docs.join(_labels(spark, sf), "id", "left").groupBy("id").agg(F.count("cat").alias("n_labels"))


@query("agg_crosstab", sql=_TL + """
SELECT d.doc_id AS id, c.node AS cat, count(l.cat) AS n FROM documents d CROSS JOIN (SELECT node FROM depth WHERE depth = 1) AS c
LEFT JOIN labels_long l ON l.id = d.doc_id AND l.cat = c.node GROUP BY d.doc_id, c.node""")
def agg_crosstab(spark, sf):
    """Document x category counts over the first level of the tree, zeros included."""
    level = T.depth(_edges(spark, sf)).where("depth = 1").select(F.col("node").alias("cat"))
    return C.crosstab(load(spark, sf, "documents").select(F.col("doc_id").alias("id")), _labels(spark, sf), level)


_GOLD = _TL + """
, br AS (SELECT parent FROM edges GROUP BY parent HAVING count(*) >= 2),
specs AS (SELECT e.parent, e.child FROM edges e JOIN br USING (parent)),
reach AS (SELECT DISTINCT c.ancestor AS node, l.id FROM labels_long l JOIN closure c ON c.descendant = l.cat),
gold AS (SELECT s.parent, s.child, r.id, CASE WHEN rc.id IS NOT NULL THEN 1 ELSE 0 END AS y
         FROM specs s JOIN reach r ON r.node = s.parent LEFT JOIN reach rc ON rc.node = s.child AND rc.id = r.id)
"""


def gold_edges(spark, sf):
    """Per-edge gold rows for every branching edge, materialised (the metric
    queries read them through several branches)."""
    from kestrel.session import cut_lineage
    e = _edges(spark, sf)
    return cut_lineage(T.edge_gold(_labels(spark, sf), e, cut_lineage(T.closure(e))))


@query("label_edge_gold", sql=_GOLD + "SELECT parent, child, id, y FROM gold", bench=True)
def label_edge_gold(spark, sf):
    """Per-edge binary datasets for all branching edges in one job."""
    return gold_edges(spark, sf)


@query("join_subtree", sql=_TL + """
SELECT DISTINCT c.ancestor AS node, l.id FROM labels_long l JOIN closure c ON c.descendant = l.cat""")
def join_subtree(spark, sf):
    """Documents whose labels intersect each node's subtree."""
    e = _edges(spark, sf)
    c = T.closure(e)
    return (_labels(spark, sf).join(c, F.col("cat") == F.col("descendant"))
            .select(F.col("ancestor").alias("node"), "id").distinct())


@query("label_node_dataset", sql=_PRIMARY + """
, onpath AS (SELECT p.id, c.ancestor AS node, dd.depth AS node_depth FROM prim p JOIN closure c ON c.descendant = p.cat
             JOIN depth dd ON dd.node = c.ancestor),
hop AS (SELECT id, node, lead(node) OVER (PARTITION BY id ORDER BY node_depth) AS next_hop FROM onpath)
SELECT id, node, next_hop FROM hop WHERE next_hop IS NOT NULL""")
def label_node_dataset(spark, sf):
    """Training rows of the node models: the child that each document's primary path takes at
    every node above its label."""
    e = _edges(spark, sf)
    return TD.next_hops(T.deepest_label(_labels(spark, sf), T.depth(e)), e, T.closure(e))


@query("label_expand_path", sql=_PRIMARY + """
, lv AS (SELECT node FROM nodes WHERE node NOT IN (SELECT parent FROM edges)),
ids AS (SELECT node, row_number() OVER (ORDER BY node) AS id_cat FROM nodes WHERE node <> 'Root')
SELECT DISTINCT p.id, i.id_cat FROM prim p JOIN lv ON lv.node = p.cat JOIN closure c ON c.descendant = p.cat
JOIN ids i ON i.node = c.ancestor""")
def label_expand_path(spark, sf):
    """Predicted leaf -> all ancestors (Root excluded) -> numeric id_cat, dedup."""
    e = _edges(spark, sf)
    dep = T.depth(e)
    prim = T.deepest_label(_labels(spark, sf), dep).join(T.leaves(e).select(F.col("node").alias("cat")), "cat")
    ids = T.nodes(e).where(F.col("node") != T.ROOT).select(
        "node", F.row_number().over(Window.orderBy("node")).alias("id_cat"))   # taxonomy-sized
    ex = prim.select("id", F.col("cat").alias("descendant")).join(T.closure(e), "descendant")
    return ex.join(ids, F.col("ancestor") == F.col("node")).select("id", "id_cat").distinct()


@query("join_lookup", sql=_TL + """
, ids AS (SELECT node, row_number() OVER (ORDER BY node) AS id_cat FROM nodes WHERE node <> 'Root')
SELECT count(i.id_cat) AS n_matched, count(*) - count(i.id_cat) AS n_orphan FROM labels_long l LEFT JOIN ids i ON i.node = l.cat""")
def join_lookup(spark, sf):
    """code -> id_cat lookup (taxonomy-sized side) with the orphan count."""
    e = _edges(spark, sf)
    ids = T.nodes(e).where(F.col("node") != T.ROOT).select(
        F.col("node").alias("cat"), F.row_number().over(Window.orderBy("node")).alias("id_cat"))
    j = _labels(spark, sf).join(ids, "cat", "left")
    return j.agg(F.count("id_cat").alias("n_matched"), (F.count(F.lit(1)) - F.count("id_cat")).alias("n_orphan"))


@query("join_semi_pool", sql="SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_semi_pool(spark, sf):
    return load(spark, sf, "documents").select("doc_id", "lang").join(load(spark, sf, "labels"), "doc_id", "left_semi")


@query("join_anti", sql="SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_anti(spark, sf):
    return load(spark, sf, "documents").select("doc_id", "lang").join(load(spark, sf, "labels"), "doc_id", "left_anti")


# ------------------------------------------------------ label aggregates ----
@query("agg_nunique_by_group", rnd=["share"], sql=with_(LABELS_LONG) + """
SELECT cat, count(DISTINCT id) AS n_docs, count(DISTINCT id) / (SELECT count(DISTINCT id) FROM labels_long) AS share
FROM labels_long GROUP BY cat""")
def agg_nunique_by_group(spark, sf):
    l = _labels(spark, sf)
    per = l.groupBy("cat").agg(F.countDistinct("id").alias("n_docs"))
    return C.share_of_total(per, "n_docs", l.select("id").distinct())


@query("agg_labels_per_doc", sql=with_(LABELS_LONG) + """
SELECT n_labels, count(*) AS n_docs FROM (SELECT id, count(*) AS n_labels FROM labels_long GROUP BY id) AS _x GROUP BY n_labels""")
def agg_labels_per_doc(spark, sf):
    per = _labels(spark, sf).groupBy("id").agg(F.count(F.lit(1)).alias("n_labels"))
    return per.groupBy("n_labels").agg(F.count(F.lit(1)).alias("n_docs"))


@query("agg_top_categories", rnd=["share"], sql=with_(LABELS_LONG) + """
SELECT cat, n, n / (SELECT count(*) FROM labels_long) AS share FROM (SELECT cat, count(*) AS n FROM labels_long GROUP BY cat) AS _x
ORDER BY n DESC, cat LIMIT 10""")
def agg_top_categories(spark, sf):
    """Top-10 categories with their share of label rows (a top-k report)."""
    l = _labels(spark, sf)
    per = l.groupBy("cat").agg(F.count(F.lit(1)).alias("n"))
    top = per.orderBy(F.col("n").desc(), "cat").limit(10)
    return C.share_of_total(top, "n", l, out="share")


@query("sort_topk", sql=with_(LABELS_LONG) + """
SELECT cat, count(*) AS n FROM labels_long GROUP BY cat ORDER BY n ASC, cat LIMIT 5""")
def sort_topk(spark, sf):
    """nsmallest(5): ordered limit (TakeOrderedAndProject)."""
    return _labels(spark, sf).groupBy("cat").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "cat").limit(5)


@query("topic_select_min_support", sql=with_(LABELS_LONG) + """
SELECT cat, count(DISTINCT id) AS n_docs, CASE WHEN count(DISTINCT id) >= 30 THEN 'selected' ELSE 'below_min_support' END AS decision
FROM labels_long GROUP BY cat""")
def topic_select_min_support(spark, sf):
    per = _labels(spark, sf).groupBy("cat").agg(F.countDistinct("id").alias("n_docs"))
    return per.withColumn("decision", F.when(F.col("n_docs") >= 30, "selected").otherwise("below_min_support"))


# --------------------------------------------------------- corpus build -----
@query("corpus_merge_split", sql="""
WITH tr AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT doc_id, text, 'train' AS split, true AS fit, CAST(NULL AS VARCHAR) AS lang FROM tr
UNION ALL
SELECT doc_id, text, 'test', false, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM tr)""")
def corpus_merge_split(spark, sf):
    """Cleaned labelled documents as the training table, all documents as the test table:
    one corpus, ids of the first win, only they are fitted on."""
    d, lab = load(spark, sf, "documents"), load(spark, sf, "labels").select("doc_id")
    train = d.join(lab, "doc_id", "left_semi").select("doc_id", K.text_clean("text").alias("text"))
    return C.merge_split(train, d.select("doc_id", "text", "lang"), "doc_id", pool="train_only") \
        .select("doc_id", "text", "split", "fit", "lang")


@query("corpus_dedup_ids", sql="""
SELECT conv_id, role, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS r
FROM conversations) AS _x WHERE r = 1""")
def corpus_dedup_ids(spark, sf):
    """First row per id with a total order."""
    from kestrel.operators.panel import dedup_keep_first
    c = load(spark, sf, "conversations")
    return dedup_keep_first(c, ["conv_id"], ["turn", "role", "text"]).select("conv_id", "role", "turn")


_PATTERN_SQL = """
, pool AS (SELECT d.doc_id, (CAST(l.quality AS INTEGER) << 3) | (CAST(l.toxic AS INTEGER) << 2)
                  | (CAST(d.lang = 'en' AS INTEGER) << 1) | CAST(d.n_chars > 2000 AS INTEGER) AS pattern
           FROM documents d JOIN labels l USING (doc_id))
"""


@query("bit_pattern", sql="WITH x AS (SELECT 1) " + _PATTERN_SQL + "SELECT doc_id, pattern FROM pool")
def bit_pattern(spark, sf):
    return C.pattern_pool(load(spark, sf, "documents"), load(spark, sf, "labels"))


_ALLOC = "WITH x AS (SELECT 1) " + _PATTERN_SQL + """
, cnt AS (SELECT pattern, count(*) AS n FROM pool GROUP BY pattern),
raw AS (SELECT pattern, n, 100.0 * n / (SELECT sum(n) FROM cnt) AS ideal FROM cnt),
r0 AS (SELECT pattern, n, ideal, CAST(round_even(ideal, 0) AS BIGINT) AS k0 FROM raw),
fix AS (SELECT *, 100 - (SELECT sum(k0) FROM r0) AS gap, (SELECT count(*) FROM r0) AS m, row_number() OVER (ORDER BY k0 DESC, pattern) AS turn FROM r0),
alloc AS (SELECT pattern, n, least(n, greatest(0, k0 + sign(gap) * (abs(gap) // m + CASE WHEN turn <= abs(gap) % m THEN 1 ELSE 0 END))) AS k FROM fix)
"""


@query("corpus_stratified_sample", sql=_ALLOC + """
, ranked AS (SELECT p.doc_id, p.pattern, row_number() OVER (PARTITION BY p.pattern ORDER BY (p.doc_id * 2654435761) % 1000003, p.doc_id) AS r
             FROM pool p)
SELECT r.doc_id, r.pattern FROM ranked r JOIN alloc a USING (pattern) WHERE r.r <= a.k""")
def corpus_stratified_sample(spark, sf):
    """Proportional allocation of 100 draws over 4-bit patterns (banker's
    rounding, +-1 repair by remainder), then a deterministic per-stratum draw."""
    pool = C.pattern_pool(load(spark, sf, "documents"), load(spark, sf, "labels"))
    return C.stratified_sample(pool, "pattern", "doc_id", 100)


@query("corpus_sample_drift", rnd=["pool_rate", "sample_rate", "delta_pp"], sql=_ALLOC + """
, ranked AS (SELECT p.doc_id, p.pattern, row_number() OVER (PARTITION BY p.pattern ORDER BY (p.doc_id * 2654435761) % 1000003, p.doc_id) AS r
             FROM pool p),
smp AS (SELECT r.doc_id, r.pattern FROM ranked r JOIN alloc a USING (pattern) WHERE r.r <= a.k),
bits AS (SELECT 'quality' AS flag, 3 AS b UNION ALL SELECT 'toxic', 2 UNION ALL SELECT 'en', 1 UNION ALL SELECT 'long', 0)
SELECT flag, (SELECT avg(((pattern >> b) & 1)) FROM pool) AS pool_rate, (SELECT avg(((pattern >> b) & 1)) FROM smp) AS sample_rate,
       100 * ((SELECT avg(((pattern >> b) & 1)) FROM smp) - (SELECT avg(((pattern >> b) & 1)) FROM pool)) AS delta_pp FROM bits""")
def corpus_sample_drift(spark, sf):
    pool = C.pattern_pool(load(spark, sf, "documents"), load(spark, sf, "labels"))
    smp = C.stratified_sample(pool, "pattern", "doc_id", 100)
    return C.presence_drift(pool, smp, "pattern", {"quality": 3, "toxic": 2, "en": 1, "long": 0})


@query("corpus_leaf_cap_sample", sql=with_(LABELS_LONG) + """
, leafdocs AS (SELECT id, cat FROM labels_long WHERE cat LIKE '%/%'),
ok AS (SELECT cat FROM leafdocs GROUP BY cat HAVING count(*) >= 10),
capped AS (SELECT l.id, row_number() OVER (PARTITION BY l.cat ORDER BY (l.id * 2654435761) % 1000003, l.id) AS r
           FROM leafdocs l JOIN ok USING (cat))
SELECT DISTINCT id FROM capped WHERE r <= 20""")
def corpus_leaf_cap_sample(spark, sf):
    """Leaves with >= 10 documents, at most 20 per leaf, union of ids."""
    leafdocs = _labels(spark, sf).where(F.col("cat").contains("/"))
    return C.leaf_cap_sample(leafdocs, "cat", "id", min_docs=10, cap=20)


@query("corpus_split_80_20", sql="""
WITH s AS (SELECT doc_id, lang, count(*) OVER (PARTITION BY lang) AS n,
                  row_number() OVER (PARTITION BY lang ORDER BY (doc_id * 2654435761) % 1000003, doc_id) AS r FROM documents)
SELECT doc_id, lang, CASE WHEN (doc_id * 7919) % 100 < 80 THEN 'train' ELSE 'test' END AS split,
       CASE WHEN r <= (n * 80 + 50) // 100 THEN 'train' ELSE 'test' END AS stratified FROM s""")
def corpus_split_80_20(spark, sf):
    """Every document's side in the plain split and in the one stratified by language."""
    d = load(spark, sf, "documents").select("doc_id", "lang")
    return C.stratified_split(C.hash_split(d, "doc_id"), "lang", "doc_id", out="stratified")


@query("pack_labels", sql=_TL + """
SELECT l.id, string_agg(d.depth || ':' || l.cat, ';' ORDER BY d.depth || ':' || l.cat) AS packed
FROM labels_long l JOIN depth d ON d.node = l.cat GROUP BY l.id""")
def pack_labels(spark, sf):
    """level:cat;level:cat... per document (sorted)."""
    dep = T.depth(_edges(spark, sf))
    j = _labels(spark, sf).join(dep.select(F.col("node").alias("cat"), "depth"), "cat")
    return C.pack_labels(j, "id", "depth", "cat")


@query("unpack_labels", sql=_TL + """
, packed AS (SELECT l.id, string_agg(d.depth || ':' || l.cat, ';' ORDER BY d.depth || ':' || l.cat) AS packed
             FROM labels_long l JOIN depth d ON d.node = l.cat GROUP BY l.id)
SELECT id, split_part(item, ':', 2) AS cat FROM (SELECT id, unnest(string_split(packed, ';')) AS item FROM packed) AS _u""")
def unpack_labels(spark, sf):
    p = pack_labels(spark, sf)
    return p.select("id", F.explode(F.split("packed", ";")).alias("item")) \
        .select("id", F.split_part("item", F.lit(":"), F.lit(2)).alias("cat"))


@query("text_clean", sql="""
SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS clean FROM documents""")
def text_clean(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", K.text_clean("text").alias("clean"))
