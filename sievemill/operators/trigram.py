"""Keyword search through an inverted index of trigrams, which tells the blocks of rows that may match.

The catalog is written in blocks, each a folder of its own, beside an index of which trigrams of which visible column occur in which
block, sorted by column and trigram. A keyword's literal pieces, between its wildcards, need all of their trigrams in one column of a
block; only such blocks are read, and the rows in them are judged as ``search`` judges them. A keyword all of whose pieces are under
three characters names no trigram: then every block is read.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.sources.shared_tables import make_folder, read_saved, write_text

from . import search
from .chunk import global_positions

SIZE = 3
ROWS = 65_536
BLOCK = "_block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def grams_of(cell: Column) -> Column:
    """The distinct trigrams of a cell, A-Z in lower case; the empty array for null. A look-ahead finds them all in one pass."""
    found = F.regexp_extract_all(F.translate(cell, _UPPER, _LOWER), F.lit(f"(?s)(?=({'.' * SIZE}))"), F.lit(1))
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def pieces(keyword: str) -> list[str]:
    """The literal pieces of a keyword, in lower case, that are long enough to have a trigram."""
    return [p for p in re.split("[%_]", keyword.translate(str.maketrans(_UPPER, _LOWER))) if len(p) >= SIZE]


def keyword_grams(keyword: str) -> list[str]:
    return sorted({p[i : i + SIZE] for p in pieces(keyword) for i in range(len(p) - SIZE + 1)})


def build(df: DataFrame, folder: str, order: list[str], metadata: DataFrame | None = None, rows: int = ROWS) -> None:
    """Write the catalog's blocks of ``rows`` rows in the given order, and their index, into an empty folder."""
    spark = df.sparkSession
    columns = search.visible_columns(df, metadata)
    make_folder(spark, folder)
    placed = global_positions(df, order, "_n").withColumn(BLOCK, F.floor((F.col("_n") - 1) / rows).cast("int")).drop("_n")
    placed.repartition(BLOCK).write.partitionBy(BLOCK).parquet(f"{folder}/rows")
    stored = spark.read.parquet(f"{folder}/rows")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), grams_of(search.as_stored(df, c)).alias("grams")) for c in columns]))
    each = stored.select(BLOCK, cells.alias("c")).select("c.column", F.explode("c.grams").alias("gram"), BLOCK).distinct()
    each.repartitionByRange("column", "gram").sortWithinPartitions("column", "gram", BLOCK).write.parquet(f"{folder}/index")
    write_text(spark, f"{folder}/columns.json", json.dumps({"all": df.columns, "visible": columns}))


def candidate_blocks(spark: SparkSession, folder: str, keyword: str) -> list[int] | None:
    """Blocks that have all trigrams of the keyword in one visible column; none (null) if it names no trigram. A number for each
    block reaches the driver, and with it the plan that reads them."""
    wanted = keyword_grams(keyword)
    if not wanted:
        return None
    index = spark.read.parquet(f"{folder}/index").filter(F.col("gram").isin(wanted))
    full = index.groupBy("column", BLOCK).agg(F.count("*").alias("n")).filter(F.col("n") == len(wanted))
    return sorted(r[0] for r in full.select(BLOCK).distinct().collect())


def find(spark: SparkSession, folder: str, keyword: str) -> DataFrame:
    """All rows of which a visible column holds the keyword, by SQL's LIKE; the same as a search over the table, in its columns."""
    saved = read_saved(spark, f"{folder}/columns.json")
    if saved is None:
        raise ValueError(f"{folder} has no index")
    named = json.loads(saved)
    blocks = candidate_blocks(spark, folder, keyword)
    rows = spark.read.parquet(f"{folder}/rows")
    if blocks is not None:
        rows = rows.filter(F.col(BLOCK).isin(blocks) if blocks else F.lit(False))
    return rows.filter(search.keyword_predicate(rows, named["visible"], keyword)).select(named["all"])


def find_any(spark: SparkSession, folder: str, keywords: list[str]) -> DataFrame:
    """Rows that any of the keywords finds, each once for each keyword, with it as ``keyword``."""
    return reduce(DataFrame.union, [find(spark, folder, k).withColumn("keyword", F.lit(k)) for k in keywords])
