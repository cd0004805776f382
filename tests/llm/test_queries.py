"""Queries with SQL agree with it on the sample tables; the others run over whole tables."""

import math
import os

import duckdb
import pytest

llm = pytest.importorskip("tessella.llm")

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        if name.endswith(".parquet"):
            con.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return con


def shown(value):
    return repr(round(value, 9)) if isinstance(value, float) and not math.isnan(value) else str(value)


def test_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in llm.QUERIES) == list(range(1, len(llm.QUERIES) + 1))


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_agrees_with_sql(spark, duck, name):
    df = llm.QUERIES[name](spark, SF)
    relation = duck.sql(llm.ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(relation.columns)
    order = [relation.columns.index(c) for c in cols]
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    assert got == sorted(tuple(shown(r[i]) for i in order) for r in relation.fetchall())


@pytest.mark.parametrize("name", sorted(set(llm.QUERIES) - set(llm.ORACLES)))
def test_runs_over_the_whole_table(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op3_") else ("documents", "doc_id")
    rows = llm.QUERIES[name](spark, SF).collect()
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    assert {r[key] for r in rows} <= ids
    assert len(rows) == len(ids) or name.startswith("op10_")
