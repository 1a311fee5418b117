"""Metadata-driven search: keyword, collection, tag and flag filters, numeric order and a limit as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import tags
from sievemill.functions import text as X

from .chunk import global_positions

PREVIEW = 50
COLLECTION = "main_collection"


@dataclass
class Request:
    """What a user asks for."""

    keyword: str = ""
    dataset: str = "full"
    tags: dict[str, str] = field(default_factory=dict)
    flags: dict[str, bool] = field(default_factory=dict)
    sort: str | None = None
    descending: bool = False
    top: int | None = None


def visible_columns(df: DataFrame, metadata: DataFrame | None) -> list[str]:
    """Shown columns in display order; without metadata all of them."""
    if metadata is None:
        return df.columns
    shown = metadata.filter(F.col("display_group").isin("main", "expand")).orderBy("order_index").select("column_name").collect()  # one row a column
    return [r[0] for r in shown if r[0] in df.columns]


def as_stored(df: DataFrame, column: str) -> Column:
    """The text of a cell: flags as 1 and 0, whole numbers of a real column with ``.0``."""
    kind = dict(df.dtypes)[column]
    return F.col(column).cast("int").cast("string") if kind == "boolean" else F.col(column).cast("string")


def like(cell: Column, keyword: str) -> Column:
    """SQL's LIKE with the keyword anywhere: ASCII case aside, ``%`` and ``_`` of the keyword are wildcards, no escapes."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    wanted = keyword.translate(str.maketrans(upper, lower)).replace("\\", "\\\\")
    return F.translate(cell, upper, lower).like(f"%{wanted}%")


def keyword_predicate(df: DataFrame, columns: list[str], keyword: str) -> Column:
    """Any of the columns matches; nulls are neutral. Without a keyword every row passes."""
    if not keyword:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [F.coalesce(like(as_stored(df, c), keyword), F.lit(False)) for c in columns], F.lit(False))


def in_main_collection() -> Column:
    return F.lower(F.trim(F.coalesce(F.col(COLLECTION).cast("string"), F.lit("")))) == "yes"


def is_true(c: Column) -> Column:
    """The spellings of a set flag; null is neither set nor unset."""
    return F.when(c.isNotNull(), c.cast("string").isin("1", "true", "True", "1.0"))


def search(df: DataFrame, request: Request, metadata: DataFrame | None = None, pos: str | None = None) -> DataFrame:
    """Visible columns of the rows asked for."""
    columns = visible_columns(df, metadata)
    out = df
    if request.dataset == "main" and COLLECTION in df.columns:
        out = out.filter(in_main_collection())
    out = out.filter(keyword_predicate(df, columns, request.keyword))
    for column, tag in request.tags.items():
        out = out.filter(tags.has_tag(F.col(column), tag))
    for column, wanted in request.flags.items():
        out = out.filter(is_true(F.col(column)) == F.lit(wanted))
    ties = [F.col(pos)] if pos else []
    if request.sort:
        number = F.col(request.sort).cast("string").try_cast("double")
        number = F.when(~F.isnan(number), number)
        out = out.orderBy(number.desc_nulls_last() if request.descending else number.asc_nulls_last(), *ties)
    elif ties and request.top is not None:
        out = out.orderBy(*ties)
    out = out.select(columns)
    return out if request.top is None else out.limit(request.top)


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, tag, position, preview, n_more``: distinct tags of each column by lower case, the first 50 for the preview."""
    rows = reduce(DataFrame.union, [df.select(F.lit(c).alias("column_name"), F.explode(tags.split_tags(F.col(c))).alias("tag")) for c in columns]).distinct()
    # all columns' tags are numbered in one order by ranges; a column's own numbers follow from where it begins
    placed = global_positions(rows.withColumn("low", F.lower("tag")), ["column_name", "low", "tag"], "at")
    spans = placed.groupBy("column_name").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = (F.col("at") - F.col("first") + 1).cast("int")
    each = placed.join(spans, "column_name").withColumn("position", own)
    return each.select("column_name", "tag", "position", (F.col("position") <= PREVIEW).alias("preview"), F.greatest(F.col("n") - PREVIEW, F.lit(0)).cast("int").alias("n_more"))


def access_label(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("Unknown")).when(is_true(c), F.lit("Accessible")).otherwise(F.lit("Not accessible"))


def plain_number(c: Column) -> Column:
    """A whole number of a real column without its point."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(X.clean(c))
