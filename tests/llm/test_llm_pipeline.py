"""Entry, contracts and the pipeline's stages on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["op3_line_dedup", "op10_benchmark_decontamination"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name])
    cols = sorted(c[0] for c in want.description)
    want = want.df()[cols]
    got = E.queries()[name](spark, SF).toPandas()[cols]
    assert sorted(map(repr, got.values.tolist())) == sorted(map(repr, want.values.tolist()))


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept, sizes = docs, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, kept, SF).write.parquet(f"{tmp_path}/{i}")
        kept = spark.read.parquet(f"{tmp_path}/{i}")
        assert kept.columns == docs.columns
        sizes.append(kept.count())
        if i == 0:
            left = {r.doc_id for r in kept.select("doc_id").collect()}
            assert sum(labels[d] == 1 for d in labels if d not in left) <= 0.03 * len(labels)
    assert sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[3] < sizes[2] and sizes[4] < sizes[3]
    last = corpus_pipeline.run(spark, SF)
    assert last.count() == sizes[4] and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(last.columns)


NAMES = ["_n_chunks", "_n_lines", "_gone", "_here", "_id", "_text_hash", "_text", "_th", "_h", "row", "id", "k", "score", "fp", "n_hit", "label"]


def test_stages_take_odd_rows_and_any_column_names(spark):
    text = "\n".join(f"line {i} of some text" for i in range(12))
    rows = [(i, t, "en", "s", len(t or ""), *[f"{c} {i}" for c in NAMES]) for i, t in enumerate(
        [None, "", " \n ", text, text, "word " * 30_000, "a short one"])]
    rows += [rows[3], (None, "no id", "en", "s", 5, *["x"] * len(NAMES))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in NAMES))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).collect()
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name != "byte_bpe":
            assert out and all(r.__fields__ == docs.columns for r in out)
            assert all(r._gone == f"_gone {r.doc_id}" and r.k == f"k {r.doc_id}" for r in out if r.doc_id is not None)
        if name == "line_dedup":
            assert len(out) == len(rows) and sum(r.text == text for r in out) == 2     # the row that is there twice
        if name == "simhash_near_dedup":
            assert sorted(r.doc_id is None or r.doc_id for r in out) == sorted([0, 3, 5, 6, True])
        if name in ("benchmark_decontamination", "byte_bpe"):
            assert len(out) == len(rows)
