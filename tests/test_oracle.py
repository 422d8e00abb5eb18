"""A fast subset of the registered queries against their DuckDB SQL at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001

FAST = ["feature_table", "churn_label", "rule_churn_score", "engineer_features", "process_features",
        "at_risk_top", "member_search", "daily_activity", "member_timeline", "stratified_split",
        "classification_report", "roc_auc", "scan_json_map", "scan_json_records", "scan_csv", "best_model",
        "score_one", "save_pipeline", "sink_feature_columns"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def cell(v):
        return repr(round(v, 6)) if isinstance(v, float) else repr(v)
    return sorted("|".join(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("customer", "part", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), ocols)


def test_every_query_of_the_catalog_has_sql():
    from cohortlens.plans.catalog import QUERIES
    from cohortlens.plans.oracle_sql import ORACLE
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
