"""Product codes of vectors: exact integer k-means whose assignments are found through segment-mean lower bounds.

Components become integers, vectors are cut into PARTS equal parts, and each part position has a codebook that starts as the parts
of the smallest ids. A round is one pass over the written integer vectors: tasks assign every part to its nearest entry and emit
sums and counts for each entry, Spark adds them, and the driver, which holds nothing but the codebooks, takes floored means.

The nearest entry is found coarse to fine. With a part and an entry cut into blocks of L components, block sums S and norms r of
what is left when each block's mean is taken away, |v - e|^2 >= sum (S_v - S_e)^2 / L + (r_v - r_e)^2. One block gives a bound for
all entries; the entry of the least bound is measured exactly, and entries whose bound is beyond that distance leave. Blocks are
halved for those that are left, and what is left in the end has its exact integer distance. Bounds are loosened by more than the
rounding error, so that no nearest entry leaves, ties included.

Defined results: vectors that are null, or hold a null, a NaN or an infinity, take no part, nor does a null id; nor do vectors
whose length is not a multiple of PARTS, is 0, or is not that of the smallest id's remaining vector; rows that repeat an id each
come back and each count, the first entries being the smallest rows by id, then vector; fewer rows than ENTRIES make fewer entries;
equal distances go to the lower entry, so a repeated entry stays unused and as it is; null labels are one label; other columns
are not read; an empty table gives no rows. Components must be small enough for distances to stay below 2^53.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import only, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors that are assigned at once.
ROWS = 8192

#: Entry, component: a codebook for each part position.
Codebooks = list[np.ndarray]


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str, scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """``vec_id, label, x``: the integer vectors of the rows that take part, whatever their length."""
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    fits = F.col(vec_id).isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.size(x) > 0) & (F.size(x) % parts == 0)
    return vectors.filter(fits).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), whole.alias("x"))


class Blocks:
    """Block sums of some vectors and the norms of what is left beside the blocks' means, by number of blocks."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.square = (x * x).sum(1)
        self._levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def level(self, blocks: int) -> tuple[np.ndarray, np.ndarray]:
        if blocks not in self._levels:
            n = self.x.shape[1] // blocks
            sums = self.x.reshape(len(self.x), blocks, n).sum(2)
            rest = np.maximum(n * self.square - (sums * sums).sum(1), 0) / n
            self._levels[blocks] = sums, np.sqrt(rest)
        return self._levels[blocks]


def levels(width: int) -> list[int]:
    """Numbers of blocks, from one on, doubled while blocks are equal and longer than a component."""
    found = [1]
    while width % (2 * found[-1]) == 0 and width > 2 * found[-1]:
        found.append(2 * found[-1])
    return found


def bounds(v: Blocks, e: Blocks, rows: np.ndarray, cols: np.ndarray, blocks: int) -> np.ndarray:
    """Lower bounds of the squared distances of pairs, loosened by more than their rounding."""
    (s, r), (t, q) = v.level(blocks), e.level(blocks)
    n = v.x.shape[1] // blocks
    gap = (s[rows] - t[cols]).astype(np.float64)
    low = (gap * gap).sum(-1) / n + (r[rows] - q[cols]) ** 2
    return low - 1e-9 * (v.square[rows] + e.square[cols]) - 1


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each row's nearest entry, the lower of equal ones, its exact squared distance, and how many exact distances were taken."""
    v, e = Blocks(x), Blocks(entries)
    every = np.arange(len(x))
    coarse, *finer = levels(x.shape[1])
    low = bounds(v, e, every[:, None], np.arange(len(entries))[None], coarse)
    entry = low.argmin(1)
    best = ((x - entries[entry]) ** 2).sum(1)
    alive = low <= best[:, None]
    alive[every, entry] = False
    rows, cols = np.nonzero(alive)
    for blocks in finer:
        left = bounds(v, e, rows, cols, blocks) <= best[rows]
        rows, cols = rows[left], cols[left]
    if len(rows):
        exact = ((x[rows] - entries[cols]) ** 2).sum(1)
        order = np.lexsort((cols, exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        at, theirs, other = rows[first], exact[first], cols[first]
        better = (theirs < best[at]) | (theirs == best[at]) & (other < entry[at])
        entry[at[better]], best[at[better]] = other[better], theirs[better]
    return entry, best, len(x) + len(rows)


def _matrices(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and integer vectors of each ROWS rows of a batch."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    for a in range(0, len(flat), ROWS):
        yield a, flat[a : a + ROWS]


def _tally(books: Codebooks, width: int):
    """For each entry and component the sum over the parts assigned to it, and their number; of the rows of a task."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = width // len(books)
        sums, counts = np.zeros((len(books), len(books[0]), own), np.int64), np.zeros((len(books), len(books[0])), np.int64)
        for batch in found:
            for _, x in _matrices(batch, 0, width):
                for p, book in enumerate(books):
                    part = np.ascontiguousarray(x[:, p * own : (p + 1) * own])
                    entry, _, _ = nearest(part, book)
                    np.add.at(sums[p], entry, part)
                    counts[p] += np.bincount(entry, minlength=len(book))
        p, e = np.nonzero(counts)
        rows = np.repeat(np.arange(len(p)), own)
        place = np.tile(np.arange(own), len(p))
        columns = [p[rows].astype(np.int32), e[rows].astype(np.int32), place.astype(np.int32), sums[p[rows], e[rows], place], counts[p[rows], e[rows]]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "place", "total", "n"])

    return run


def next_codebooks(vectors: DataFrame, books: Codebooks, width: int) -> Codebooks:
    """The floored means of the parts that each entry is nearest to; an unused entry stays."""
    tallied = vectors.select("x").mapInArrow(_tally(books, width), "part int, entry int, place int, total long, n long")
    found = tallied.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # a row for each entry's component
    books = [b.copy() for b in books]
    for r in found:
        books[r.part][r.entry, r.place] = r.total // r.n
    return books


def _codes(books: Codebooks, width: int):
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = width // len(books)
        for batch in found:
            code, error = np.zeros((len(batch), len(books)), np.uint8), np.zeros(len(batch), np.int64)
            for a, x in _matrices(batch, 2, width):
                for p, book in enumerate(books):
                    entry, distance, _ = nearest(np.ascontiguousarray(x[:, p * own : (p + 1) * own]), book)
                    code[a : a + len(x), p] = entry
                    error[a : a + len(x)] += distance
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in code]), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


def codebooks_text(books: Codebooks) -> str:
    return ",".join(str(c) for book in books for entry in book for c in entry.tolist())


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks after all rounds over ``vec_id, x``, all vectors of one length; no codebooks if there are none."""
    if entries > 256:
        raise ValueError("an entry's number has to fit two hex digits")
    first = [r.x for r in vectors.orderBy("vec_id", "x").limit(entries).select("x").collect()]
    if not first:
        return []
    books = [b.copy() for b in np.split(np.array(first, np.int64), parts, axis=1)]
    for _ in range(rounds):
        books = next_codebooks(vectors, books, len(first[0]))
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of ``vec_id, label, x``."""
    schema = vectors.select("vec_id", "label").schema.add("code", "string").add("error", "long")
    return vectors.select("vec_id", "label", "x").mapInArrow(_codes(books, sum(b.shape[1] for b in books)), schema)


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector that takes part."""
    spark = vectors.sparkSession
    with only(spark) as keep:
        whole, _ = written(usable(vectors, vec_id, embedding, label, parts=parts), "integers")
        smallest = whole.orderBy("vec_id", "x").limit(1).select(F.size("x").alias("n")).collect()
        if not smallest:
            return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
        whole = whole.filter(F.size("x") == smallest[0].n)
        books = fit(whole, parts, entries, rounds)
        coded = keep(*written(encode(whole, books), "codes"))
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, errors and codebooks of all vectors."""
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def oracle_sql(scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the rows of ``compress``: every part against every entry in every round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT rn, part, y, min(distance * {entries} + entry) AS best FROM (
    SELECT p.rn, p.part, p.y, b.entry, list_sum(list_transform(list_zip(p.y, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
    FROM p JOIN b{k} b ON p.part = b.part) GROUP BY rn, part, y)""")
        if k < rounds:
            steps.append(f"""
m{k} AS (
  SELECT part, entry, list(mean ORDER BY i) AS e FROM (
    SELECT part, best % {entries} AS entry, i, floor(sum(y[i])::DOUBLE / count(*))::BIGINT AS mean FROM a{k}, (SELECT unnest(range(1, 1 + len(y))) AS i FROM p LIMIT (SELECT any_value(len(y)) FROM p)) x
    GROUP BY part, best % {entries}, i) GROUP BY part, entry),
b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM b{k} b LEFT JOIN m{k} m ON b.part = m.part AND b.entry = m.entry)""")
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT rn, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS y FROM v, (SELECT unnest(range({parts})) AS part) q
), b0 AS (SELECT part, rn - 1 AS entry, y AS e FROM p WHERE rn <= {entries}),{",".join(steps)},
c AS (
  SELECT rn, string_agg(printf('%02x', (best % {entries})::INT), '' ORDER BY part) AS code, sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY rn
), h AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS digest FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256 FROM v JOIN c USING (rn), h
"""
