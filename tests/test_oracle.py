"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import importlib.util
import os

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("check", os.path.join(ROOT, "tools", "check.py"))
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(check.QUERIES))
def test_query(spark, con, name):
    df = check.QUERIES[name](spark, SF_DIR)
    got = df.toPandas()
    assert len(set(df.columns)) == len(df.columns)
    if name not in check.ORACLES:
        assert len(got) > 0
        return
    rel = con.sql(check.ORACLES[name])
    assert sorted(rel.columns) == sorted(df.columns)
    assert check.rows_of(got) == check.rows_of(rel.df())


def test_oracles_belong_to_queries():
    assert set(check.ORACLES) <= set(check.QUERIES)
