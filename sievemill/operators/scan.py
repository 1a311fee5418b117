"""Scans over one order: folds whose state passes from row to row, run as Spark jobs over sorted ranges.

Rows are dealt into sorted ranges and written. Each range is summarised by what the ranges behind it need to know, the summaries, a
row for each range, are folded once, and what comes out enters each range as its carry. No task sees more than a range, whatever
the keys; rows that are equal in the order are spread by their place in the input.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.sources.shared_tables import written


def _within() -> WindowSpec:
    return W.partitionBy("_part").orderBy("_in")


def sorted_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows with the number of their sorted range and their place in it, ``_part, _in`` from 0, written."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie").withColumn("_part", F.spark_partition_id())
    return written(dealt.withColumn("_in", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("bigint"), 33)), "ranges")[0]


def _same(x: Any, y: Any) -> bool:
    """Equal as Spark's null-safe equality has it: nulls and NaNs equal themselves."""
    if isinstance(x, (tuple, list)) and isinstance(y, (tuple, list)):
        return len(x) == len(y) and all(map(_same, x, y))
    return x == y or (x != x and y != y)


def carried(ranges: DataFrame, summary: dict[str, Column], state: Any, fold: Callable[[Any, Row], tuple[Any, tuple]], carry: T.StructType) -> DataFrame:
    """The ranges with their carry. ``summary``: aggregates of a range; ``fold``: from the state before a range and its summary to
    the state behind it and the carry that enters it. Ranges with rows reach the driver, one row each."""
    rows = []
    for r in sorted(ranges.groupBy("_part").agg(*[c.alias(n) for n, c in summary.items()]).collect(), key=lambda r: r["_part"]):
        state, enters = fold(state, r)
        rows.append((r["_part"], *enters))
    known = ranges.sparkSession.createDataFrame(rows, T.StructType([T.StructField("_part", T.IntegerType()), *carry.fields]))
    return ranges.join(F.broadcast(known), "_part")


def _keyed(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """``_key_no``: how many changes of the keys the range has had, so that 0 is what may go on from the range before."""
    other = F.lit(False)
    for k in keys:
        other = other | ~F.col(k).eqNullSafe(F.lag(k).over(_within()))
    changed = ranges.withColumn("_other_key", (F.col("_in") > 0) & other)
    return changed.withColumn("_key_no", F.sum(F.col("_other_key").cast("int")).over(_within()))


def _at(which: Callable[[Column, Column], Column], columns: list[str]) -> Column:
    """The columns of a range's first or last row, one struct."""
    return which(F.struct(F.lit(0).alias("_"), *columns), F.col("_in"))


def runs(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """``run``, from 0 within the keys' values or over all rows without keys, and ``place``, from 1 within the run, of runs of equal
    values in order."""
    ranges = _keyed(sorted_ranges(df, [*keys, *order]), keys)
    other = F.col("_other_key") | (F.col("_in") > 0) & ~F.col(value).eqNullSafe(F.lag(value).over(_within()))
    ranges = ranges.withColumn("_run_no", F.sum(other.cast("int")).over(_within()))
    ranges = ranges.withColumn("_run", F.col("_run_no") - F.min("_run_no").over(W.partitionBy("_part", "_key_no")))
    ranges = ranges.withColumn("_place", F.row_number().over(W.partitionBy("_part", "_run_no").orderBy("_in")))
    summary = {"first": _at(F.min_by, [*keys, value]), "last": _at(F.max_by, [*keys, value, "_key_no", "_run_no", "_run", "_place"])}
    n = len(keys)

    def fold(state, r):
        first, last = tuple(r.first)[1:], tuple(r.last)[1:]
        on = state is not None and _same(state[0], first[:n])
        run_on = on and _same(state[1], first[n])
        more, rows = (state[2] + (not run_on), state[3] if run_on else 0) if on else (0, 0)
        key_no, run_no, run, place = last[n + 1 :]
        return (last[:n], last[n], run + (0 if key_no else more), place + (0 if run_no else rows)), (more, rows)

    both = carried(ranges, summary, None, fold, T.StructType([T.StructField("_more", T.LongType()), T.StructField("_rows", T.LongType())]))
    run = F.col("_run") + F.when(F.col("_key_no") == 0, F.col("_more")).otherwise(0)
    place = F.col("_place") + F.when(F.col("_run_no") == 0, F.col("_rows")).otherwise(0)
    return both.select(*df.columns, run.alias("run"), place.alias("place"))


def forward_fill(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The last value there was, within the keys' values or over all rows without keys."""
    ranges = _keyed(sorted_ranges(df, [*keys, *order]), keys)
    so_far = W.partitionBy("_part", "_key_no").orderBy("_in").rowsBetween(W.unboundedPreceding, 0)
    filled = {c: f"_filled_{i}" for i, c in enumerate(columns)}
    ranges = ranges.withColumns({name: F.last(c, ignorenulls=True).over(so_far) for c, name in filled.items()})
    n = len(keys)
    summary = {"first": _at(F.min_by, keys), "last": _at(F.max_by, [*keys, "_key_no", *filled.values()])}

    def fold(state, r):
        first, last = tuple(r.first)[1:], tuple(r.last)[1:]
        enters = state[1] if state is not None and _same(state[0], first) else (None,) * len(columns)
        left = tuple(v if v is not None or last[n] else e for v, e in zip(last[n + 1 :], enters, strict=True))
        return (last[:n], left), enters

    carry = T.StructType([T.StructField(f"_carry_{i}", df.schema[c].dataType) for i, c in enumerate(columns)])
    both = carried(ranges, summary, None, fold, carry)
    value = lambda c: F.coalesce(F.col(filled[c]), F.when(F.col("_key_no") == 0, F.col(f"_carry_{columns.index(c)}")))
    return both.select(*[value(c).alias(c) if c in filled else F.col(c) for c in df.columns])


class Packing:
    """Where a chunk stands after some units, for every number of rows that it may have had before them: units go together until a
    chunk has ``limit`` rows or the next would pass it, a larger unit stands alone. Numbers that meet are carried on as one."""

    def __init__(self, limit: int):
        self.limit = limit
        self.rows, self.opened = list(range(limit)), [0] * limit
        self.of, self.more = list(range(limit)), [0] * limit

    @staticmethod
    def step(rows: int, n: int, limit: int) -> tuple[int, bool]:
        """The open chunk's rows behind a unit, 0 if it is full, and whether the unit opens a chunk."""
        opens = not rows or rows + n > limit
        rows = n if opens else rows + n
        return (0 if rows >= limit else rows), opens

    def add(self, n: int) -> None:
        for i, rows in enumerate(self.rows):
            self.rows[i], opens = self.step(rows, n, self.limit)
            self.opened[i] += opens
        if len(set(self.rows)) < len(self.rows):
            self._meet()

    def _meet(self) -> None:
        first: dict[int, int] = {}
        for rows in self.rows:
            first.setdefault(rows, len(first))
        opened: list[int] = [-1] * len(first)
        for rows, n in zip(self.rows, self.opened, strict=True):
            if opened[first[rows]] < 0:
                opened[first[rows]] = n
        for e, i in enumerate(self.of):
            k = first[self.rows[i]]
            self.more[e] += self.opened[i] - opened[k]
            self.of[e] = k
        self.rows, self.opened = list(first), opened

    def behind(self) -> list[tuple[int, int]]:
        """For each number of rows before: rows of the open chunk, and chunks opened."""
        return [(self.rows[i], self.opened[i] + more) for i, more in zip(self.of, self.more, strict=True)]


def _summed(limit: int):
    """The units of a sorted range, then the range's summary: its first and last lane, whether it has but one, and ``behind`` of
    the last lane; a lane that begins within the range begins with nothing."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, first, lane, one, packing = TaskContext.get().partitionId(), 0, None, None, True, Packing(limit)
        for batch in found:
            for own, rows in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if first is None:
                    first = lane = own
                elif own != lane:
                    lane, one, packing = own, False, Packing(limit)
                packing.add(rows)
            size = len(batch)
            place = pa.array(range(n, n + size), pa.int64())
            n += size
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([part] * size, pa.int32()), place, pa.nulls(size, pa.string())], names=["lane", "unit", "n", "part", "place", "summary"])
        if n:
            text = json.dumps([first, lane, one, packing.behind()])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.array([text])], names=["lane", "unit", "n", "part", "place", "summary"])

    return run


def _numbered(limit: int, enters: dict[int, tuple[str | None, int, int]]):
    """The chunk of each unit, of whole ranges in their order."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lane, rows, chunk = None, None, 0, 0
        for batch in found:
            numbers = []
            for own_part, own, n in zip(*(batch.column(k).to_pylist() for k in (3, 0, 2)), strict=True):
                if own_part != part:
                    part = own_part
                    lane, rows, chunk = enters[part]
                if own != lane:
                    lane, rows, chunk = own, 0, 0
                rows, opens = Packing.step(rows, n, limit)
                chunk += opens
                numbers.append(chunk)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(numbers, pa.int64())], names=["lane", "unit", "chunk"])

    return run


def packed(units: DataFrame, limit: int) -> DataFrame:
    """``lane, unit, chunk`` of ``lane, at, unit, n``: units of n rows, in the order of lane, at and unit, in chunks of at most
    ``limit`` rows, numbered from 1 within the lane; a larger unit stands alone. ``limit`` numbers for each range reach the driver."""
    schema = "lane string, unit string, n long, part int, place long, summary string"
    dealt = units.repartitionByRange("lane", "at", "unit").sortWithinPartitions("lane", "at", "unit").select("lane", "unit", F.col("n").cast("long").alias("n"))
    ranges, _ = written(dealt.mapInArrow(_summed(limit), schema), "units")
    enters, lane, rows, opened = {}, None, 0, 0
    for r in sorted(ranges.filter("summary is not null").select("part", "summary").collect()):
        first, last, one, behind = json.loads(r.summary)
        if first != lane:
            rows = opened = 0
        enters[r.part] = (first, rows, opened)
        rows, more = behind[rows if one else 0]
        lane, opened = last, (opened if one else 0) + more
    own = ranges.filter("summary is null").drop("summary").repartition("part").sortWithinPartitions("part", "place")
    return written(own.mapInArrow(_numbered(limit, enters), "lane string, unit string, chunk long"), "chunks")[0]
