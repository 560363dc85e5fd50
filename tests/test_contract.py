"""Every registered query equals its SQL oracle (DuckDB) on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
TABLES = ["events"]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


# the training-data operators are tested in tests/llm
OWN = sorted(set(entry_mod.queries()) - set(entry_mod.LLM_QUERIES) - {"pipeline"})


def test_every_query_has_an_oracle():
    missing = set(OWN) - set(entry_mod.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, oracle, name):
    df = entry_mod.queries()[name](spark, SF)
    got = [r.asDict() for r in df.collect()]
    exp_df = oracle.sql(entry_mod.oracle_sql()[name]).df()
    exp = exp_df.to_dict("records")
    cols = sorted(df.columns)
    assert cols == sorted(exp_df.columns)
    assert len(got) == len(exp)
    assert _rows(got, cols) == _rows(exp, cols)


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["dt", "appid", "n", "sv"]
    assert df.count() > 0
