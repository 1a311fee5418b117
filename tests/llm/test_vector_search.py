import numpy as np
from pyspark.sql import types as T

from sievemill.llm import vector_search as V

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType()), T.StructField("score", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)


def brute(rows, k=5, every=50):
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v is not None and all(a is not None and np.isfinite(a) for a in v)]
    out = []
    for i, q in good:
        if i % every == 0:
            found = sorted((-int(q @ x), j) for j, x in good if j != i and len(x) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def run(spark, rows, every=50):
    v = V.usable(frame(spark, rows), "vec_id", "embedding")
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in V.top_k(v.filter(f"vec_id % {every} = 0"), v).collect())


def test_ties_and_clusters(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(0, 0.2, (6, 8))
    rows = [(i, (base[i % 6] + (rng.normal(0, 0.01, 8) if i % 3 else 0)).tolist()) for i in range(300)]
    assert run(spark, rows) == brute(rows)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []), (100, []), (6, [1.0, -3.0]), (7, [1.0]), (None, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [-0.001, 0.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []


def test_blocks_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.3, 16).tolist()) for i in range(200)]
    monkeypatch.setattr(V, "BLOCK", 3)
    assert run(spark, rows, 10) == brute(rows, every=10)


def test_the_search_stops_early():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 40, (40, 32))
    x = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 1, (4000, 32)))
    q = x[:5]
    pivots = V.pick_pivots(x[:500])
    ids = np.arange(len(x))
    best = V.Best.none(5, 5)
    evaluated = V.search(best, 0, ids[:5], q, V.distances(q, pivots), ids, x, V.distances(x, pivots))
    assert evaluated < 0.5 * 5 * len(x)
    # what is known from earlier vectors stops later ones sooner
    assert V.search(best, 0, ids[:5], q, V.distances(q, pivots), ids + len(x), x, V.distances(x, pivots)) < evaluated


def test_small_parts_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, 8 + i % 2).tolist()) for i in range(300)] + [(299, [0.1] * 8), (7, [0.2] * 8)]
    monkeypatch.setattr(V, "ASKED", 4)
    monkeypatch.setattr(V, "ROWS", 7)
    assert run(spark, rows[:300], 10) == brute(rows[:300], every=10)
    assert len(run(spark, rows, 10)) == len(brute(rows, every=10))


def test_the_plan_holds_no_queries(spark, monkeypatch):
    rows = [(i, [float(i % 7), 1.0]) for i in range(100)]
    monkeypatch.setattr(V, "BLOCK", 2)
    v = V.usable(frame(spark, rows), "vec_id", "embedding")
    plan = V.top_k(v.filter("vec_id % 10 = 0"), v)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Union" not in plan and "Scan parquet" in plan


def test_exact_over_five_thousand_vectors(spark):
    from pathlib import Path

    import duckdb
    import pytest

    sf = Path("/root/testdata/sf0.1")
    if not sf.exists():
        pytest.skip("test tables are not here")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet/*.parquet'" if (sf / "embeddings.parquet").is_dir() else f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    found = con.execute(V.OP4_SQL)
    names = [d[0] for d in found.description]
    want = sorted(tuple(r[names.index(c)] for c in ("query_id", "rank", "vec_id", "score")) for r in found.fetchall())
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in V.op4_pivot_top_k(spark, str(sf)).collect()) == want
