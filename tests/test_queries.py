"""Every query with SQL agrees with it; every other one runs. The optional operators have tests of their own."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessella.catalogue import PUBLISHED

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {n: q for n, q in entry.queries().items() if not n.startswith("op")}
ORACLES = {n: sql for n, sql in entry.oracle_sql().items() if n in QUERIES}

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


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    relation = duck.sql(ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(relation.columns)
    order = [relation.columns.index(c) for c in cols]
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    assert got == sorted(tuple(shown(r[i]) for i in order) for r in relation.fetchall())


UNCHECKED = sorted(n for n in set(QUERIES) - set(ORACLES) if n != "pipeline")


@pytest.mark.parametrize("name", UNCHECKED)
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_long_jobs_stand_apart():
    assert set(PUBLISHED) <= set(QUERIES)
    assert not any(fn in QUERIES.values() for fn in PUBLISHED.values())


@pytest.mark.parametrize("job", ["cross_validate", "fit_final_and_score", "feature_ablation", "echo_robustness", "skill_cv"])
def test_published_jobs_are_queries(job):
    assert f"{job}_published" in QUERIES


def test_entry(spark):
    assert entry.entry(spark).count() > 0
