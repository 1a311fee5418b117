"""Exact distinct counts of overlapping labels from mergeable bitmaps.

A row has a dense number; a label's state is the set of its rows' numbers, in bitmaps of ``bitmap_construct_agg``'s size. States of
parts of a table, or of days, are united by ``bitmap_or_agg``; a level above is the union of the codes below it; a count is the
number of bits. So all levels come from one pass over the labels, and a later day adds its own labels only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunk import global_positions


def numbered_rows(ids: DataFrame, row_id: str, known: DataFrame | None = None) -> DataFrame:
    """``id, number``: a number from 1 for every distinct id; ids that ``known`` has keep theirs, others follow behind the last one.
    A null id takes no part."""
    own = ids.select(F.col(row_id).alias("id")).filter("id is not null").distinct()
    if known is None:
        return global_positions(own, ["id"], "number")
    last = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first().n
    new = global_positions(own.join(known.select("id"), "id", "left_anti"), ["id"], "number")
    return known.select("id", "number").union(new.select("id", (F.col("number") + last).alias("number")))


def label_state(labels: DataFrame, numbers: DataFrame) -> DataFrame:
    """``code, bucket, bits`` of ``id, label``: the rows of each label. Rows that repeat a label add nothing; a label of null takes
    no part."""
    own = labels.filter("label is not null").join(numbers, "id")
    bit = F.bitmap_construct_agg(F.bitmap_bit_position("number"))
    return own.groupBy(F.col("label").alias("code"), F.bitmap_bucket_number("number").alias("bucket")).agg(bit.alias("bits"))


def merged(*states: DataFrame) -> DataFrame:
    """The state of all parts together; they may overlap."""
    return reduce(DataFrame.unionByName, states).groupBy("code", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def raised(state: DataFrame, parents: DataFrame) -> DataFrame:
    """The state one level up: ``parents`` has ``code, parent``. A code may have several parents, and one without any is left out."""
    above = state.join(parents.select("code", "parent").distinct(), "code").withColumn("code", F.col("parent"))
    return above.groupBy("code", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(state: DataFrame) -> DataFrame:
    """``code, n``: how many rows each code has."""
    return state.groupBy("code").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def rolled_up(state: DataFrame, dimension: DataFrame) -> DataFrame:
    """``level, code, n`` for every code and major code of ``dimension`` (``code, major_code``), 0 where there is none, and for all
    rows with a label that the dimension has."""
    codes = dimension.select("code", F.col("major_code").alias("parent")).distinct()
    majors = raised(state, codes)
    every = lambda df, level: df.select(F.lit(level).alias("level"), "code", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    low = every(codes.select("code").distinct().join(counts(state), "code", "left"), "sub")
    high = every(codes.select(F.col("parent").alias("code")).distinct().join(counts(majors), "code", "left"), "major")
    total = majors.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")).agg(F.sum(F.bitmap_count("bits")).alias("n"))
    return low.union(high).union(every(total.withColumn("code", F.lit("")), "total"))
