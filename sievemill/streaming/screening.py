"""An extension: the keyword screen over a stream of papers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievemill.functions import text as X
from sievemill.operators import screen


def screened_stream(papers: DataFrame, pattern: str, scope: str | None, arrived: str = "arrived_at", late: str = "1 day") -> DataFrame:
    """New papers that pass the lexicons, each title once within the watermark."""
    keyed = papers.withColumn("title_key", X.title_key(F.col("title"))).withWatermark(arrived, late)
    return screen.keyword_screen(keyed.dropDuplicatesWithinWatermark(["title_key"]), pattern, scope)


def counts_by_window(papers: DataFrame, arrived: str = "arrived_at", width: str = "1 day", late: str = "1 day") -> DataFrame:
    return papers.withWatermark(arrived, late).groupBy(F.window(arrived, width)).agg(F.count("*").alias("n"))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what there is to Parquet and stop; the checkpoint makes the next run go on from there."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
