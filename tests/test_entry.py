"""Driver contract: entry runs, every query has a callable, oracles are a subset;
a sample of queries agrees with DuckDB at sf0.001."""

import duckdb
import pytest

from conftest import SF

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["label", "class_pos", "period_class", "n", "share"]


def test_registry_shape():
    from __spark_entry__ import oracle_sql, queries
    q, s = queries(), oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100


@pytest.mark.parametrize("name", ["feature_engineer", "column_prune", "corr_matrix", "describe", "stratified_split",
                                  "oversample", "scorecard", "roc_points", "ensemble_interval", "knn_join",
                                  "mutual_information", "permutation_importance", "shap_local"])
def test_matches_duckdb(spark, name):
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import rows
    from __spark_entry__ import oracle_sql, queries
    sdf = queries()[name](spark, SF)
    srecs = [r.asDict(recursive=True) for r in sdf.collect()]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(oracle_sql()[name])
    drecs = [dict(zip(rel.columns, row)) for row in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    assert rows(srecs, cols) == rows(drecs, cols)
