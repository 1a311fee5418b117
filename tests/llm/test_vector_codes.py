"""Codes against a plain k-means in Python integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from sievemill.llm import vector_codes as M


def plain(rows, parts=8, entries=16, rounds=6):
    """``rows``: id, vector, label of those that take part, in order of id and vector."""
    x = [(i, [math.floor(4096 * v) for v in vec], label) for i, vec, label in rows]
    own = len(x[0][1]) // parts
    cut = lambda vec, p: vec[p * own : (p + 1) * own]
    books = [[cut(vec, p) for _, vec, _ in x[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            found = {}
            for _, vec, _ in x:
                found.setdefault(near(cut(vec, p), books[p])[1], []).append(cut(vec, p))
            for k, own_parts in found.items():
                books[p][k] = [sum(c) // len(own_parts) for c in zip(*own_parts, strict=True)]
    out, totals = [], {}
    for i, vec, label in x:
        best = [near(cut(vec, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
        totals[label] = totals.get(label, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, code, error, totals[label], digest) for i, code, error, label in out)


SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("code", T.StringType()), T.StructField("x", T.StringType())])


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], label, "c", "d") for i, v, label in rows], SCHEMA)


def as_rows(df):
    return sorted(tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def vectors(n, width, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), rng.normal(size=width).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in rng.permutation(n)]


@pytest.mark.parametrize("width", [8, 16, 24, 64])
def test_codes_of_random_vectors(spark, width):
    rows = vectors(150, width)
    assert as_rows(M.compress(table(spark, rows).repartition(3))) == plain(sorted(rows))


def test_awkward_vectors(spark):
    good = vectors(30, 16, 2)
    twice = [(3, good[0][1], 5), (3, good[0][1], 5), (40, good[4][1], None), (41, good[4][1], None)]
    bad = [(50, None, 1), (51, [], 1), (52, [0.5] * 15 + [None], 1), (53, [float("nan")] + [0.0] * 15, 1), (54, [float("inf")] + [0.0] * 15, 1), (55, [0.1] * 17, 1), (56, [0.1] * 24, 1), (None, [0.1] * 16, 1)]
    rows = good + twice + bad
    assert as_rows(M.compress(table(spark, rows))) == plain(sorted(good + twice, key=lambda r: r[:2]))


def test_few_equal_and_no_vectors(spark):
    rows = [(i, [0.25] * 8, None) for i in range(5)]
    got = as_rows(M.compress(table(spark, rows)))
    assert got == plain(rows) and {r[1] for r in got} == {"00" * 8} and {r[2] for r in got} == {0}
    assert as_rows(M.compress(table(spark, []))) == []
    assert as_rows(M.compress(table(spark, [(1, None, 1)]))) == []


def test_bounds_are_conservative_and_filter():
    rng = np.random.default_rng(4)
    for scale in (3, 1000, 2**20):
        centers = rng.integers(-scale, scale, (16, 8)) * 8
        x = np.concatenate([centers[rng.integers(0, 16, 400)] + rng.integers(-scale, scale, (400, 8)) // 2, centers])
        exact = ((x[:, None] - centers[None]) ** 2).sum(2)
        v, e = M.Blocks(x), M.Blocks(centers)
        for blocks in M.levels(8):
            low = M.bounds(v, e, np.arange(len(x))[:, None], np.arange(16)[None], blocks)
            assert (low <= exact).all()
        entry, distance, evaluated = M.nearest(x, centers)
        assert (entry == exact.argmin(1)).all() and (distance == exact.min(1)).all()
        assert evaluated < 0.6 * exact.size
    assert M.levels(8) == [1, 2, 4] and M.levels(12) == [1, 2, 4] and M.levels(1) == [1] and M.levels(3) == [1]
