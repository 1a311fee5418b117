"""Table files at the edges: CSV and JSON lines as texts, immutable snapshots, and links for export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import workbooks
from .shared_tables import exists

#: For rows that repeat long texts: a dictionary of up to so many bytes, and a look at a page's and a row group's size every so many rows.
LONG_TEXTS = {"parquet.dictionary.page.size": str(64 << 20), "parquet.page.size.row.check.min": "4", "parquet.block.size.row.check.min": "4"}


def read_csv_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file with a header, all cells as texts, empty for null; a missing file has no rows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    found = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False, encoding="UTF-8")
    return found.select(*[(F.col(f"`{c}`") if c in found.columns else F.lit(None)).cast("string").alias(c) for c in columns]).fillna("")


def append_rows(df: DataFrame, path: str, columns: list[str]) -> None:
    """Append rows, projected onto the columns; absent ones are empty."""
    df.select(*[(F.col(c) if c in df.columns else F.lit("")).cast("string").alias(c) for c in columns]).write.mode("append").parquet(path)


def read_json_lines(spark: SparkSession, path: str, column: str) -> DataFrame:
    return spark.read.schema(T.StructType([T.StructField(column, T.StringType())])).json(path)


def read_urls(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One column of a CSV file or of JSON lines."""
    return read_csv_rows(spark, path, [column]) if path.endswith(".csv") else read_json_lines(spark, path, column)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def snapshot(df: DataFrame, path: str) -> str:
    """Write once: an existing snapshot is left as it is. The digest of its rows, whatever their order, in upper case."""
    spark = df.sparkSession
    if not exists(spark, path):
        df.write.parquet(path)
    rows = spark.read.parquet(path)
    row = F.sha2(F.to_json(F.struct(*rows.columns)), 256)
    # the sum of the digests' parts does not depend on the order of rows
    parts = [F.coalesce(F.sum(F.conv(F.substring(row, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string") for i in range(8)]
    return rows.agg(F.upper(F.sha2(F.concat_ws(",", *parts), 256)).alias("digest")).first()[0]


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def link_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """For exports: the cells that are written as links, ``column, url``."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("url")) for c in columns])
    return df.select(F.explode(F.filter(cells, lambda x: x.url.rlike(r"(?i)^https?://\S+$"))).alias("c")).select("c.*")


def write_excel(df: DataFrame, path: str, links: tuple[str, ...] = (), sheet: str = "Sheet1") -> None:
    """A folder of workbooks. Addresses are texts, but for those in the columns ``links``, which are links as well."""
    workbooks.write(df, path, links, sheet)


def read_excel(spark: SparkSession, path: str, sheet: str | int = 0, as_text: bool = False) -> DataFrame:
    """A sheet of the workbooks at a path. ``as_text``: nothing is inferred, null is empty; else columns of numbers are numbers."""
    found = workbooks.read(spark, path, sheet)
    return found.fillna("") if as_text else workbooks.with_types(found)


def with_long_texts(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows in a copy of their session whose Parquet writers keep a text of megabytes, which ``columns`` repeat from row to
    row, once in a file. Writers give up a dictionary of more than 1 MB otherwise, and then gather a hundred such texts before they
    look at a page's size. The caller's session stays as it is, settings that were given hold, and ``columns`` get no statistics,
    which would compare each text twice more."""
    spark = df.sparkSession
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    given = spark.sparkContext._jsc.hadoopConfiguration()
    for k, v in {**LONG_TEXTS, **{f"parquet.column.statistics.enabled#{c}": "false" for c in columns}}.items():
        if own.conf.get(k, None) is None and given.get(k) is None:
            own.conf.set(k, v)
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own._jsparkSession, df._jdf.queryExecution().logical()), own)
