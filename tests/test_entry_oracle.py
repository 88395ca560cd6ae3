"""Driver contract smoke test and a DuckDB oracle check on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SAMPLE = ["strat_portfolio_return", "dq_coverage", "reg_fama_macbeth", "tree_path", "eval_pooled_edges",
          "text_tfidf", "ts_acf", "reg_pair_report", "corpus_stratified_sample", "win_turnover"]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["d", "pi", "mkt"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_match(spark, name):
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
              "labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sp = E.queries()[name](spark, SF).toPandas()
    od = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(od.columns)
    assert len(sp) == len(od)
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from oracle_check import digest
    assert digest(sp, True)[0] == digest(od, True)[0]
