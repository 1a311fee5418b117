"""Scans over one order against plain loops."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sievemill.operators import chunk, scan


def plain_runs(rows, size):
    """``rows``: key, order, value, in order of key and order."""
    out, state = [], None
    for key, k, v in rows:
        if state is None or state[0] != key:
            state = (key, v, 0, 1)
        elif state[1] == v:
            state = (key, v, state[2], state[3] + 1)
        else:
            state = (key, v, state[2] + 1, 1)
        out.append((key, k, state[2], (state[3] - 1) // size))
    return out


def plain_chunks(sizes, limit):
    out, rows, n = [], 0, 0
    for s in sizes:
        if not rows or rows + s > limit:
            n, rows = n + 1, 0
        rows += s
        out.append(n)
        rows = 0 if rows >= limit else rows
    return out


@pytest.mark.parametrize("values", [1, 2, 5])
def test_runs_over_one_order_and_by_key(spark, values):
    rng = random.Random(values)
    rows = [(rng.choice([0, 0, 0, 1, 2]), k, rng.choice([None, "a", "b", "c", "d"][:values])) for k in range(700)]
    df = spark.createDataFrame(rows, "p int, k int, v string").repartition(7)
    keyed = sorted(rows, key=lambda r: r[:2])
    got = chunk.run_batches(df, ["p"], ["k"], "v", 3)
    assert got.columns == ["p", "k", "v", "run", "batch_in_run"] and dict(got.dtypes)["run"] == dict(got.dtypes)["batch_in_run"] == "bigint"
    assert sorted((r.p, r.k, r.run, r.batch_in_run) for r in got.collect()) == plain_runs(keyed, 3)
    whole = [(0, k, v) for _, k, v in rows]
    assert sorted((0, r.k, r.run, r.batch_in_run) for r in chunk.run_batches(df, [], ["k"], "v", 3).collect()) == plain_runs(whole, 3)


def test_fill_over_one_order_and_by_key(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 0, 0, 1]), k, rng.choice([None] * 40 + [k]), rng.choice([None] * 9 + [f"x{k}"])) for k in range(600)]
    df = spark.createDataFrame(rows, "p int, k int, v long, w string").repartition(5)

    def plain(rows):
        out, held, key = {}, (None, None), object()
        for p, k, v, w in rows:
            held = held if p == key else (None, None)
            key = p
            held = tuple(new if new is not None else old for new, old in zip((v, w), held, strict=True))
            out[k] = held
        return out

    got = chunk.forward_fill(df, [], ["k"], ["v", "w"])
    assert got.columns == df.columns and {r.k: (r.v, r.w) for r in got.collect()} == plain([(0, *r[1:]) for r in rows])
    by_key = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert {r.k: (r.v, r.w) for r in chunk.forward_fill(df, ["p"], ["k"], ["v", "w"]).collect()} == plain(by_key)


def test_equal_rows_nans_and_no_rows(spark):
    rows = [(1, float("nan"))] * 40 + [(2, None)] * 3
    df = spark.createDataFrame(rows, "k int, v double").repartition(6)
    got = chunk.run_batches(df, [], ["k"], "v", 50)
    assert {(r.run, r.batch_in_run, r["count"]) for r in got.groupBy("run", "batch_in_run").count().collect()} == {(0, 0, 40), (1, 0, 3)}
    none = df.limit(0)
    assert chunk.run_batches(none, [], ["k"], "v", 2).collect() == chunk.forward_fill(none, [], ["k"], ["v"]).collect() == []
    assert chunk.atomic_chunks(none.withColumn("g", F.lit("x")), "k", "g", 2).collect() == []


def test_one_hot_key_is_no_single_task(spark):
    df = spark.range(20_000).select(F.lit(7).alias("p"), F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    out = chunk.run_batches(df, ["p"], ["k"], "v", 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(p" not in plan
    assert out.filter("run <> k or batch_in_run <> 0").count() == 0


def test_packings_meet_and_compose():
    rng = random.Random(4)
    for limit, most in itertools.product((1, 2, 7, 25), (1, 3, 30)):
        sizes = [rng.randint(1, most) for _ in range(200)]
        summary = scan.Packing(limit)
        for s in sizes:
            summary.add(s)
        for before, (rows, opened) in enumerate(summary.behind()):
            left, n = before, 0
            for s in sizes:
                left, opens = scan.Packing.step(left, s, limit)
                n += opens
            assert (left, n) == (rows, opened)


@pytest.mark.parametrize("lanes", [1, 3])
def test_chunks_over_one_order(spark, lanes):
    rng = random.Random(lanes)
    rows = [(k, rng.choice([None, "", "g1", "g2", "g3", f"h{k % 90}", f"i{k // 4}"]), rng.choice(["a", "b", None][:lanes])) for k in range(900)]
    df = spark.createDataFrame(rows, "pos int, grp string, lane string").repartition(6)
    want = {}
    for lane in {r[2] for r in rows}:
        units = {}
        for k, g, own in rows:
            if own == lane:
                units.setdefault(g or f"r{k}", []).append(k)
        order = sorted(units.values(), key=lambda u: u[0])
        for u, n in zip(order, plain_chunks([len(u) for u in order], 10), strict=True):
            want |= dict.fromkeys(u, n)
    got = chunk.atomic_chunks(df, "pos", "grp", 10, F.col("lane") if lanes > 1 else None)
    assert {r.pos: r.chunk_id for r in got.collect()} == want


def test_a_million_units(spark):
    size = F.pmod(F.xxhash64("id"), F.lit(9)) + 1
    units = spark.range(1_000_000).select(F.lit("").alias("lane"), F.col("id").alias("at"), F.col("id").cast("string").alias("unit"), size.alias("n"))
    got = scan.packed(units, 25).select(F.col("unit").cast("int").alias("at"), "chunk").toPandas().sort_values("at")
    sizes = units.orderBy("at").select("n").toPandas().n.tolist()
    assert got.chunk.tolist() == plain_chunks(sizes, 25)
