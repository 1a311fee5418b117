"""Every registered query of the catalog operators against its SQL."""

import math
from pathlib import Path

import duckdb
import pytest

from sievemill.plans import catalog_queries as Q


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return float(f"{v:.6g}")
    return v


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_is_its_sql(spark, sf, duck, name):
    got = Q.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    mine = [tuple(plain(r[c]) for c in cols) for r in got.collect()]
    found = duck.execute(Q.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    theirs = [tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall()]
    assert sorted(mine, key=str) == sorted(theirs, key=str)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_plans_have_no_python(spark, sf, name):
    plan = Q.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_entry_has_all_queries():
    import __spark_entry__ as e

    assert set(Q.QUERIES) <= set(e.queries()) and set(Q.ORACLE_SQL) <= set(e.oracle_sql())
