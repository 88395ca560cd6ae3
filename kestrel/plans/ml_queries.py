"""spark.ml model family (survey 2.11, rows-checked): linear SVM, elastic-net
logistic regression, gradient boosting, degree-2 SVM, truncated SVD, model zoo,
parameter grid, save/load, pluggable estimators and per-edge linear models
trained for every branching edge in one aggregation."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, Normalizer, PCA, PolynomialExpansion
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from kestrel.operators import corpus as C
from kestrel.operators import evaluate as E
from kestrel.operators import linear as LI
from kestrel.operators import sparse as SP
from kestrel.operators import text as X
from kestrel.operators import topdown as TD
from kestrel.operators import tree as T
from kestrel.plans.registry import query
from kestrel.plans.tree_queries import _edges, gold_edges
from kestrel.session import ensure_checkpoint_dir
from kestrel.sources import bindings as B
from kestrel.sources.tables import load


def with_tokens(df):
    """Add the token array JVM-side (codegen'd regexp_extract_all, same
    pattern and lowercasing as a RegexTokenizer) so the pipeline stages that
    need several passes (vocabulary, idf) reuse materialised tokens instead of
    re-tokenising the corpus in every pass."""
    t = F.regexp_extract_all(F.lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(X.TOKEN_LOWER2), 0)
    return df.withColumn("tokens", t).drop("text")


def labelled_docs(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "text")
    lab = load(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return C.hash_split(with_tokens(d.join(lab, "doc_id")), "doc_id")


def featurizer(kind: str = "tfidf") -> list:
    """Term frequencies -> idf -> L2 on a ``tokens`` column.  Terms are hashed to
    2^14 columns: every token of the corpus counts, and no vocabulary has to pass through
    the driver."""
    cv = HashingTF(inputCol="tokens", outputCol="tf" if kind == "tfidf" else "features", numFeatures=1 << 14)
    if kind == "count":
        return [cv]
    return [cv, IDF(inputCol="tf", outputCol="idf"), Normalizer(inputCol="idf", outputCol="features", p=2.0)]


def train_frame(df):
    """Cache a training frame for the passes of an iterative optimiser (adaptive
    execution coalesces small shuffle partitions; the layout is left to it)."""
    return df.cache()


def fit_concurrently(tasks, workers: int = 4):
    """Run independent model fits as concurrent Spark jobs (each fit is itself
    distributed; threads only keep the cluster busy across small fits)."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=workers) as ex:
        return list(ex.map(lambda f: f(), tasks))


def _union(parts):
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def _metrics(pred, name):
    m = E.binary_metrics(pred.withColumn("y", F.col("label").cast("int")).withColumn("p", F.col("prediction").cast("int")),
                         "y", "p")
    return m.withColumn("model", F.lit(name))


def fit_eval(spark, sf, model, name, kind="tfidf"):
    d = train_frame(labelled_docs(spark, sf))
    tr, te = d.where("split = 'train'"), d.where("split = 'test'")
    pm = Pipeline(stages=featurizer(kind) + [model]).fit(tr)
    return _metrics(pm.transform(te), name)


@query("clf_linear_svm", rnd=["accuracy", "precision", "recall", "f1"])
def clf_linear_svm(spark, sf):
    """TF-IDF -> LinearSVC, C = 1 mapped to regParam = 1 / (n C) (S13)."""
    n = labelled_docs(spark, sf).where("split = 'train'").count()
    return fit_eval(spark, sf, LinearSVC(regParam=1.0 / max(n, 1), maxIter=50, standardization=False), "linear_svm")


@query("clf_elasticnet", rnd=["accuracy", "precision", "recall", "f1"])
def clf_elasticnet(spark, sf):
    return fit_eval(spark, sf, LogisticRegression(elasticNetParam=0.5, regParam=0.01, maxIter=50), "elasticnet")


@query("clf_maxent", rnd=["accuracy", "precision", "recall", "f1"])
def clf_maxent(spark, sf):
    return fit_eval(spark, sf, LogisticRegression(elasticNetParam=0.0, regParam=0.01, maxIter=50), "maxent")


def embeddings(spark, sf):
    e = load(spark, sf, "embeddings")
    return C.hash_split(e.select("vec_id", array_to_vector("embedding").alias("features"),
                                 (F.col("label") % 2).cast("double").alias("label")), "vec_id")


def _fit_dense(spark, sf, stages, name):
    e = train_frame(embeddings(spark, sf))
    pm = Pipeline(stages=stages).fit(e.where("split = 'train'"))
    return _metrics(pm.transform(e.where("split = 'test'")), name)


@query("clf_boosting", rnd=["accuracy", "precision", "recall", "f1"])
def clf_boosting(spark, sf):
    """Gradient boosted trees (100 rounds, depth 3, step 0.1) on dense vectors."""
    return _fit_dense(spark, sf, [GBTClassifier(maxIter=100, maxDepth=3, stepSize=0.1, seed=7)], "gbt")


@query("clf_poly2_svm", rnd=["accuracy", "precision", "recall", "f1"])
def clf_poly2_svm(spark, sf):
    """Reduce to 8 components, degree-2 expansion, linear SVM."""
    st = [PCA(k=8, inputCol="features", outputCol="pc"), PolynomialExpansion(degree=2, inputCol="pc", outputCol="poly"),
          LinearSVC(featuresCol="poly", regParam=0.01, maxIter=50)]
    return _fit_dense(spark, sf, st, "poly2_svm")


SVD_COMPONENTS = 20


@query("text_svd", rnd=["singular_value", "explained_variance_ratio", "coordinate"], dp=5)
def text_svd(spark, sf):
    """TF-IDF over the whole vocabulary -> truncated SVD: the coordinate of every document in
    each component, with the component's singular value and its share of the squared
    Frobenius norm.  Documents without terms have zeros."""
    from kestrel.session import cut_lineage
    docs = load(spark, sf, "documents").select("doc_id", "text")
    with SP.tfidf_rows(docs, "doc_id", "text") as (rows, _), SP.truncated_svd(rows, "doc_id", SVD_COMPONENTS) as (s, left, _):
        total = rows.where(F.size("keys") > 0).count()     # rows have unit length or are empty
        pos = F.posexplode(F.slice("vec", 1, SVD_COMPONENTS)).alias("i", "coordinate")
        values = F.array(*[F.lit(float(x)) for x in s])
        out = left.select("doc_id", pos).withColumn("singular_value", F.get(values, "i"))
        return cut_lineage(out.select("doc_id", (F.col("i") + 1).cast("long").alias("component"), "singular_value",
                                      (F.col("singular_value") ** 2 / max(total, 1)).alias("explained_variance_ratio"), "coordinate"))


@query("clf_model_zoo", rnd=["accuracy", "precision", "recall", "f1"])
def clf_model_zoo(spark, sf):
    """Representation x model comparison on one cached split, sorted by F1."""
    d = train_frame(labelled_docs(spark, sf))
    tr, te = d.where("split = 'train'"), d.where("split = 'test'")

    def fit_one(kind, name, m):
        return lambda: _metrics(Pipeline(stages=featurizer(kind) + [m]).fit(tr).transform(te), f"{kind}_{name}")
    tasks = [fit_one(kind, name, m) for kind in ("tfidf", "count")
             for name, m in (("svm", LinearSVC(regParam=0.01, maxIter=30)),
                             ("logreg", LogisticRegression(regParam=0.01, maxIter=30)))]
    out = _union(fit_concurrently(tasks))
    return out.orderBy(F.col("f1").desc(), "model")


@query("clf_param_grid", rnd=["best_auc"], dp=4)
def clf_param_grid(spark, sf):
    """regParam grid with TrainValidationSplit (parallel fits) on cached features."""
    e = train_frame(embeddings(spark, sf))
    svc = LinearSVC(maxIter=30)
    grid = ParamGridBuilder().addGrid(svc.regParam, [0.001, 0.01, 0.1, 1.0]).build()
    tvs = TrainValidationSplit(estimator=svc, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(),
                               trainRatio=0.8, parallelism=4, seed=11)
    m = tvs.fit(e.where("split = 'train'"))
    best = max(range(len(grid)), key=lambda i: m.validationMetrics[i])
    return spark.createDataFrame([(float(grid[best][svc.regParam]), float(m.validationMetrics[best]))],
                                 "best_reg_param double, best_auc double")


@query("clf_save_load", sql="""
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_diff FROM documents JOIN labels USING (doc_id) WHERE (doc_id * 7919) % 100 >= 80""")
def clf_save_load(spark, sf):
    """Persist a fitted pipeline under the shared checkpoint folder, reload it
    and check predictions agree."""
    import uuid
    d = labelled_docs(spark, sf)
    pm = Pipeline(stages=featurizer() + [LogisticRegression(regParam=0.01, maxIter=20)]).fit(d.where("split = 'train'"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    pm.write().overwrite().save(path)
    re = PipelineModel.load(path)
    te = d.where("split = 'test'")
    a = pm.transform(te).select("doc_id", F.col("prediction").alias("p1"))
    b = re.transform(te).select("doc_id", F.col("prediction").alias("p2"))
    return a.join(b, "doc_id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("p1") != F.col("p2"), 1)).alias("n_diff"))


@query("udf_model_plug", rnd=["accuracy", "precision", "recall", "f1"])
def udf_model_plug(spark, sf, factory=None):
    """Pluggable estimator contract: ``factory(edge) -> Estimator``; one model
    per first-level edge (Root -> lang), trained on the shared features."""
    factory = factory or (lambda edge: LogisticRegression(regParam=0.01, maxIter=20))
    d = with_tokens(load(spark, sf, "documents").select("doc_id", "text", "lang")).cache()
    feats = Pipeline(stages=featurizer()).fit(d).transform(d).select("doc_id", "lang", "features")
    feats = train_frame(C.hash_split(feats, "doc_id"))
    langs = [r[0] for r in d.select("lang").distinct().orderBy("lang").collect()]   # tree-sized list

    def fit_edge(lang):
        def run():
            data = feats.withColumn("label", (F.col("lang") == lang).cast("double"))
            m = factory(("Root", lang)).fit(data.where("split = 'train'"))
            return _metrics(m.transform(data.where("split = 'test'")), f"Root>{lang}")
        return run
    out = _union(fit_concurrently([fit_edge(x) for x in langs]))
    return out


# ------------------------------------------- models of all edges at once ---
COSTS = (0.1, 1.0, 10.0)   # grid of C


def edge_confusion(spark, sf, costs, split):
    """Confusion counts (parent, child, c, split) of one linear SVM per branching edge and C
    on TF-IDF rows over the whole vocabulary; every document under a node counts,
    those without any term too."""
    from kestrel.session import cut_lineage
    gold = split(gold_edges(spark, sf), "id")
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    with ExitStack() as scope:
        with SP.tfidf_rows(docs, "id", "text") as (features, _):
            slots, blocks = scope.enter_context(LI.prepared(gold, features, list(costs)))
        weights = scope.enter_context(LI.fitted(blocks, list(costs)))
        m = LI.margins(weights, slots, blocks, list(costs)).withColumn("pred", (F.col("margin") > 0).cast("int"))
        return cut_lineage(E.confusion(m, "y", "pred", by=["parent", "child", "c", "split"]))


@query("clf_edge_train_all", rnd=["micro_f1", "macro_f1", "weighted_f1", "micro_precision", "micro_recall",
                                  "micro_accuracy", "macro_precision", "macro_recall", "weighted_precision",
                                  "weighted_recall"])
def clf_edge_train_all(spark, sf):
    """Binary model per branching edge (all edges in one job, C = 1), pooled test metrics.
    Edges with one class in training are skipped."""
    c = edge_confusion(spark, sf, [1.0], C.hash_split).where("split = 'test'").drop("split", "c")
    return E.summarize(c)


def _by_split(confusion, key):
    """Pooled F1 per ``key`` and C on the validation and on the test rows."""
    val, test = (E.summarize(confusion.where(F.col("split") == s).drop("split"), key=[*key, "c"]).select(*key, "c", F.col("micro_f1").alias(n))
                 for s, n in (("val", "val_f1"), ("test", "micro_f1")))
    return val.join(test, [*key, "c"], "left")


@query("clf_c_by_depth", rnd=["val_f1", "micro_f1"])
def clf_c_by_depth(spark, sf):
    """C per tree depth: the best on validation rows (ties: the smallest), with its F1 on
    the test rows, which take no part in the choice."""
    c = edge_confusion(spark, sf, COSTS, C.three_way_split)
    dep = T.depth(_edges(spark, sf)).select(F.col("node").alias("parent"), "depth")
    s = _by_split(c.join(dep, "parent"), ["depth"])
    best = F.max_by(F.struct("c", "val_f1", "micro_f1"), F.struct("val_f1", (-F.col("c")).alias("neg"))).alias("b")
    return s.groupBy("depth").agg(best).select("depth", "b.c", "b.val_f1", "b.micro_f1")


@query("clf_c_global", rnd=["val_f1", "micro_f1"])
def clf_c_global(spark, sf):
    """One C for the whole tree: grid report by validation F1, test F1 beside it."""
    return _by_split(edge_confusion(spark, sf, COSTS, C.three_way_split), []).select("c", "val_f1", "micro_f1") \
        .orderBy(F.col("val_f1").desc(), "c")


@query("clf_node_multiclass")
def clf_node_multiclass(spark, sf):
    """One model per branching node over its children, trained on the primary labels; every
    document walks from the root to a leaf.  (id, split, gold, node, path)."""
    from kestrel.session import cut_lineage
    e = _edges(spark, sf)
    clos = cut_lineage(T.closure(e))
    prim = cut_lineage(T.deepest_label(B.labels_long(spark, sf), T.depth(e)).select("id", "cat"))
    hops = cut_lineage(C.hash_split(TD.next_hops(prim, e, clos), "id"))
    gold = C.hash_split(TD.node_gold(hops, e), "id")
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    with SP.tfidf_rows(docs, "id", "text") as (features, _):
        out = TD.walk(gold, hops.where("split = 'train'"), e, features)
    return C.hash_split(out.join(prim.withColumnRenamed("cat", "gold"), "id", "left"), "id").select("id", "split", "gold", "node", "path")


@query("eval_train_test", rnd=["accuracy", "precision", "recall", "f1"])
def eval_train_test(spark, sf):
    """Fit once, metrics on both splits (split column grouped)."""
    d = train_frame(labelled_docs(spark, sf))
    pm = Pipeline(stages=featurizer() + [LogisticRegression(regParam=0.01, maxIter=30)]).fit(d.where("split = 'train'"))
    p = pm.transform(d).withColumn("y", F.col("label").cast("int")).withColumn("p", F.col("prediction").cast("int"))
    return E.binary_metrics(p, "y", "p", by=["split"])


@query("eval_kfold", rnd=["mean_f1", "std_f1", "mean_accuracy"])
def eval_kfold(spark, sf):
    """5-fold CV with a hash fold id: per-fold metrics, their mean / std and the
    summed confusion."""
    d = train_frame(labelled_docs(spark, sf).withColumn("fold", ((F.col("doc_id") % 5 * 7919) % 5).cast("int")))

    def fit_fold(k):
        def run():
            pm = Pipeline(stages=featurizer() + [LogisticRegression(regParam=0.01, maxIter=30)]).fit(d.where(F.col("fold") != k))
            p = pm.transform(d.where(F.col("fold") == k)).withColumn("y", F.col("label").cast("int")) \
                .withColumn("p", F.col("prediction").cast("int"))
            return E.binary_metrics(p, "y", "p").withColumn("fold", F.lit(k))
        return run
    folds = _union(fit_concurrently([fit_fold(k) for k in range(5)]))   # fixed fold count
    return folds.agg(F.avg("f1").alias("mean_f1"), F.stddev_samp("f1").alias("std_f1"),
                     F.avg("accuracy").alias("mean_accuracy"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
                     F.sum("fn").alias("fn"), F.sum("tn").alias("tn"))


@query("reg_logloss_sweep", rnd=["val_logloss", "test_logloss"], dp=5)
def reg_logloss_sweep(spark, sf):
    """lambda x feature-mask sweep of logistic regression scored by validation
    log-loss (computed as an aggregate); the minimum is re-scored on test."""
    from pyspark.ml.feature import VectorSlicer
    from pyspark.ml.functions import vector_to_array
    e = embeddings(spark, sf)
    e = e.withColumn("split", F.when((F.col("vec_id") % 10 * 7919) % 10 < 6, "train")
                     .when((F.col("vec_id") % 10 * 7919) % 10 < 8, "val").otherwise("test"))
    e = train_frame(e)
    tr = e.where("split = 'train'")
    rows = []
    fitted = {}
    for k in (8, 16, 32, 64):                 # mask: first k features (first always on)
        for lam in (0.001, 0.01, 0.1, 1.0):
            pipe = Pipeline(stages=[VectorSlicer(inputCol="features", outputCol="fk", indices=list(range(k))),
                                    LogisticRegression(featuresCol="fk", regParam=lam, maxIter=50)])
            m = pipe.fit(tr)
            fitted[(k, lam)] = m
            rows.append((k, lam, m))
    def logloss(m, part):
        p = m.transform(e.where(F.col("split") == part)).withColumn("p1", vector_to_array("probability")[1])
        p1 = F.least(F.greatest("p1", F.lit(1e-15)), F.lit(1 - 1e-15))
        return p.agg(F.avg(-(F.col("label") * F.log(p1) + (1 - F.col("label")) * F.log(1 - p1))).alias("ll"))
    res = None
    for k, lam, m in rows:
        r = logloss(m, "val").select(F.lit(k).alias("n_features"), F.lit(lam).alias("reg_param"), F.col("ll").alias("val_logloss"))
        res = r if res is None else res.unionByName(r)
    res = res.cache()
    best = res.orderBy("val_logloss", "n_features", "reg_param").first()   # one row of a 16-row grid table
    test = logloss(fitted[(best.n_features, best.reg_param)], "test").first().ll
    return res.withColumn("is_best", (F.col("n_features") == best.n_features) & (F.col("reg_param") == best.reg_param)) \
        .withColumn("test_logloss", F.when(F.col("is_best"), F.lit(test)))
