"""Work packets: runs, fixed chunks, chunks that keep groups together, and their manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.sources.shared_tables import written

from . import scan
from .link import latest


def global_positions(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """Gapless numbers from 1 in a total order, without one task for all rows: partitions are sorted ranges, each numbered by
    itself after the sizes of those before it. Only a count per partition reaches the driver."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    dealt, _ = written(dealt.withColumn("_in", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("bigint"), 33)), "numbered")
    sizes = sorted((r["_part"], r["n"]) for r in dealt.groupBy("_part").agg(F.count("*").alias("n")).collect())
    before, rows = 0, []
    for part, n in sizes:
        rows.append((part, before))
        before += n
    starts = df.sparkSession.createDataFrame(rows, "_part int, _before long")
    return dealt.join(F.broadcast(starts), "_part").withColumn(name, F.col("_in") + F.col("_before") + 1).drop("_part", "_in", "_before")


def fixed_chunks(df: DataFrame, order: list[str], size: int, name: str = "chunk_id") -> DataFrame:
    """Consecutive chunks of a fixed size, numbered from 1."""
    return global_positions(df, order, "_n").withColumn(name, (F.floor((F.col("_n") - 1) / size) + 1).cast("long")).drop("_n")


def run_batches(df: DataFrame, partition: list[str], order: list[str], value: str, size: int) -> DataFrame:
    """Runs of equal values in order, cut at ``size``: ``run, batch_in_run`` from 0 within each partition, or over all rows without
    a partition. A partition may have any number of rows: it is a scan over sorted ranges."""
    return scan.runs(df, partition, order, value).withColumn("batch_in_run", F.floor((F.col("place") - 1) / size)).drop("place")


def atomic_chunks(df: DataFrame, pos: str, group: str, limit: int, lane: Column | None = None, name: str = "chunk_id") -> DataFrame:
    """Chunks that never part the rows of a group; a group stands where its first member does. Units go together until a chunk has
    ``limit`` rows or the next would pass it; a larger one stands alone. Without a lane the chunks go over one order of all rows, else
    over each lane's for itself; both are a scan over sorted ranges."""
    text = F.lit("") if lane is None else lane.cast("string")
    unit = F.coalesce(F.when(F.col(group) != "", F.concat(F.lit("g:"), F.col(group).cast("string"))), F.concat(F.lit("r:"), F.col(pos).cast("string")))
    rows = df.withColumn("_unit", unit).withColumn("_lane", F.coalesce(F.concat(F.lit("="), text), F.lit("")))
    units = rows.groupBy(F.col("_lane").alias("lane"), F.col("_unit").alias("unit")).agg(F.min(pos).alias("at"), F.count("*").alias("n"))
    chunked = scan.packed(units, limit).select(F.col("lane").alias("_lane"), F.col("unit").alias("_unit"), F.col("chunk").cast("int").alias(name))
    return rows.join(chunked, ["_lane", "_unit"]).drop("_lane", "_unit")


def chunk_manifest(chunks: DataFrame, earlier: DataFrame, seq: str) -> DataFrame:
    """A row per chunk with what the latest earlier manifest says of it; unknown chunks are pending."""
    return chunks.join(latest(earlier, "chunk_id", seq), "chunk_id", "left").withColumn("status", F.coalesce("status", F.lit("pending")))


def merge_chunks(frames: list[DataFrame], row_id: str) -> DataFrame:
    """All chunks in one table in the order of ids; an id that comes twice is an error."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    twice = out.groupBy(row_id).count().filter("count > 1").select(row_id).limit(1).collect()
    if twice:
        raise ValueError(f"duplicate id in results: {twice[0][0]}")
    return out.orderBy(F.coalesce(F.col(row_id).try_cast("double"), F.lit(0.0)), row_id)


def forward_fill(df: DataFrame, partition: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The last value there was, within each partition, or over all rows without one."""
    return scan.forward_fill(df, partition, order, columns)
