"""The driver contract: entry, query registry and oracle SQL agree (checked at sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

ORACLE_SAMPLE = [
    "performance_report",
    "survival_report",
    "concordance",
    "km_median",
    "score_deciles",
    "sql_join_asof",
    "sql_join_range",
    "time_split",
    "upsert_table",
    "identity_column",
    "load_csv",
    "run_scripts",
]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert "roc_auc" in df.columns and len(rows) >= 0


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


def _norm(v):
    import pandas as pd

    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return v if math.isinf(v) else (None if math.isnan(v) else round(v, 6))
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF001).toPandas()
    exp = duck.execute(E.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er
