"""Exact top-k search by inner product with a pivot table.

Vectors become integers floor(scale * x). The distances of every vector to PIVOTS pivots are computed once. For a query q and a
vector x each pivot p gives |d(q, p) - d(x, p)| <= d(q, x); the largest of these lower bounds turns into an upper bound of the inner
product, (|q|^2 + |x|^2 - bound^2) / 2. In a partition the candidates of a query are evaluated in the order of their bounds, in
growing steps, until the next bound is below the k-th best score found: the rest cannot enter, ties included. The k-th best
score is carried from batch to batch, and the best k of each partition are merged.

Queries are a stated set against all rows: they are written once and numbered; a block of at most BLOCK of them at a time is sent
to one pass over the vectors, whose result is written before the next block is read, so neither the driver nor a plan ever holds
more than a block. The pivots are picked from at most SAMPLE vectors; they only steer the order, the result is exact.

Defined results: vectors that are null, or hold a null, a NaN or an infinity, take no part; a null id takes no part; vectors meet
only those of the same length; rows that repeat an id are each a candidate, except for the query of that id, and such a query
is answered once, by its smallest vector; ties go to the smaller id; an empty table gives no rows. Components must be small
enough for inner products to stay below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievemill.operators.chunk import global_positions

from .shared import new_path, only

SCALE = 256
K = 5
PIVOTS = 32
SAMPLE = 2000
BLOCK = 8192
#: Vectors and queries that meet at once.
ROWS, ASKED = 4096, 1024


def usable(vectors: DataFrame, vec_id: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: the integer vectors of the rows that take part."""
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    return vectors.filter(F.col(vec_id).isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("x"))


def pick_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Pivots far from one another: each next one is the sampled vector farthest from those before."""
    chosen = [int(np.argmax((sample**2).sum(1)))]
    far = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * x @ pivots.T, 0))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of each vector length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    first = np.concatenate([[0], np.cumsum(lengths)])
    return [(rows := np.flatnonzero(lengths == n), flat[(first[rows][:, None] + np.arange(n)).astype(np.int64)]) for n in np.unique(lengths)]


@dataclass
class Best:
    """The best k of each query so far, by falling score, then rising id; places that are not filled yet have a score of -inf."""

    ids: np.ndarray
    scores: np.ndarray

    @classmethod
    def none(cls, n: int, k: int) -> Best:
        return cls(np.full((n, k), -1, np.int64), np.full((n, k), -np.inf))

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        some = scores >= self.scores[i, -1]
        ids, scores = ids[some], scores[some]
        ids, scores = np.concatenate([self.ids[i], ids]), np.concatenate([self.scores[i], scores])
        order = np.lexsort((ids, -scores))[: self.ids.shape[1]]
        self.ids[i], self.scores[i] = ids[order], scores[order]


def search(best: Best, at: int, query_ids, q, q_table, ids, x, table) -> int:
    """Let the vectors enter the best of the queries, which stand from ``at`` on; how many products were evaluated."""
    qq, xx = (q**2).sum(1), (x**2).sum(1)
    low = np.zeros((len(q), len(x)), np.float32)
    own, theirs = q_table.astype(np.float32), table.astype(np.float32)
    for p in range(table.shape[1]):
        np.maximum(low, np.abs(own[:, p, None] - theirs[None, :, p]), out=low)
    # rounding of the bounds must not hide a candidate
    low = np.maximum(low.astype(np.float64) - 1e-2 - 1e-6 * (np.sqrt(qq)[:, None] + np.sqrt(xx)[None]), 0)
    upper = (qq[:, None] + xx[None] - low * low) / 2 + 0.5
    evaluated = 0
    for i in range(len(q)):
        bound, step, a = upper[i], 64, 0
        left = np.flatnonzero((bound >= best.scores[at + i, -1]) & (ids != query_ids[i]))
        left = left[np.argsort(-bound[left])]
        while a < len(left) and bound[left[a]] >= best.scores[at + i, -1]:
            now = left[a : a + step]
            best.add(at + i, ids[now], x[now] @ q[i])
            evaluated += len(now)
            a += step
            step *= 2
    return evaluated


def _search(queries: list[tuple[np.ndarray, np.ndarray]], pivots: dict[int, np.ndarray], k: int):
    tables = {q.shape[1]: (ids, q, distances(q, pivots[q.shape[1]])) for ids, q in queries if q.shape[1] in pivots}

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {n: Best.none(len(ids), k) for n, (ids, _, _) in tables.items()}
        for batch in found:
            all_ids = batch.column(0).to_numpy()
            for rows, x in _matrix(batch.column(1)):
                n = x.shape[1]
                if n not in tables:
                    continue
                query_ids, q, q_table = tables[n]
                for a in range(0, len(x), ROWS):
                    part, ids = x[a : a + ROWS], all_ids[rows[a : a + ROWS]]
                    table = distances(part, pivots[n])
                    for b in range(0, len(q), ASKED):
                        own = slice(b, b + ASKED)
                        search(kept[n], b, query_ids[own], q[own], q_table[own], ids, part, table)
        for n, best in kept.items():
            at, place = np.nonzero(best.scores > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(tables[n][0][at]), pa.array(best.ids[at, place]), pa.array(best.scores[at, place].astype(np.int64))], names=["query_id", "vec_id", "score"])

    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each row of ``queries`` among ``vectors``, both ``vec_id, x`` as of ``usable``."""
    spark = vectors.sparkSession
    with only(spark) as keep:
        sample = vectors.select("x").limit(SAMPLE).toArrow().column(0).combine_chunks()
        pivots = {x.shape[1]: pick_pivots(x) for _, x in _matrix(sample)} if len(sample) else {}
        asked = global_positions(queries.groupBy("vec_id").agg(F.min("x").alias("x")), ["vec_id"], "place")
        n_blocks = -(-asked.count() // BLOCK)

        def ranked(block: int) -> DataFrame:
            some = asked.filter((F.col("place") > block * BLOCK) & (F.col("place") <= (block + 1) * BLOCK)).select("vec_id", "x").toArrow().combine_chunks()  # a block of queries
            ids, x = (some.column(c).combine_chunks() for c in (0, 1))
            own = [(ids.to_numpy()[rows], q) for rows, q in _matrix(x)]
            known = {**{q.shape[1]: q[:1] for _, q in own}, **pivots}
            found = vectors.mapInArrow(_search(own, known, k), "query_id long, vec_id long, score long")
            order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

        if n_blocks <= 1:
            return ranked(0) if n_blocks else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        path = new_path(spark, "found")
        for block in range(n_blocks):
            ranked(block).write.mode("append").parquet(path)
        return keep(spark.read.parquet(path), path)


def op4_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every fiftieth vector with all others."""
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return top_k(vectors.filter("vec_id % 50 = 0"), vectors)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
