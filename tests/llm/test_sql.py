"""Every corpus query that SQL can express against its SQL."""

from pathlib import Path

import duckdb
import pytest

from sievemill.llm import queries as Q


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_is_its_sql(spark, sf, duck, name):
    got = Q.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    plain = lambda v: float(f"{v:.6g}") if isinstance(v, float) else v
    mine = [tuple(plain(r[c]) for c in cols) for r in got.collect()]
    found = duck.execute(Q.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    theirs = [tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall()]
    assert sorted(mine, key=str) == sorted(theirs, key=str)
