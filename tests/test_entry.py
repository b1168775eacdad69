"""Driver contract: entry runs, every query has a callable, oracles run in
DuckDB and agree with Spark on the smallest tables for a fast subset."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E
from corvid.plans.inputs import TABLES

FAST = ["read_lines", "count_words", "readability_report", "dale_chall", "train_gd", "gram_stats",
        "total_gradient", "backtracking_line_search", "adapt_u", "cross_validate_mf", "read_sparse_points",
        "train_fw", "k_sweep", "train_gd_history"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "dcf" in df.columns


def test_oracles_are_a_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    a = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    b = sorted(tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in res.fetchall())
    assert a == b
