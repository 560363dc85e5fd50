"""Queries of the training-data operators that SQL can express, against DuckDB."""

import duckdb
import pytest

from tidelog.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = oracle.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    assert _sorted(got) == _sorted(rel.select(*cols).fetchall())


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
