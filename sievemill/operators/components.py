"""Connected components of a graph given as an edge table, all at once or batch by batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.sources.shared_tables import make_folder, only, read_saved, remove, write_text, written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``id, component`` of every end of an edge, the component being the smallest id that can be reached.

    Minimum labels travel along the edges, and each round also replaces a label by its own label, so that long chains
    shorten by halves. Labels are written each round in the shared folder; both sides of the join on labels, whose keys may
    be hot, are plain scans, which adaptive execution can split. Nulls in either column make no edge; an edge from an id to
    itself gives a component of one.
    """
    spark = edges.sparkSession
    ends = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u is not null and v is not null")
    both, edge_path = written(ends.union(ends.select("v", "u")).distinct(), "edges")
    labels, path = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).withColumnRenamed("u", "id"), "labels")
    while True:
        told = both.join(labels.select(F.col("id").alias("v"), "label"), "v").select(F.col("u").alias("id"), "label", F.lit(None).cast(labels.schema["label"].dataType).alias("was"))
        own = labels.select("id", "label", F.col("label").alias("was"))
        hooked, hooked_path = written(own.union(told).groupBy("id").agg(F.min("label").alias("label"), F.max("was").alias("was")), "labels")
        up = hooked.select(F.col("id").alias("label"), F.col("label").alias("further"))
        jumped, jumped_path = written(hooked.join(up, "label").select("id", F.col("further").alias("label"), "was"), "labels")
        moved = not jumped.filter("label <> was").isEmpty()
        remove(spark, path, hooked_path)
        labels, path = jumped, jumped_path
        if not moved:
            remove(spark, edge_path)
            return labels.select("id", F.col("label").alias("component"))


class StoredComponents:
    """Components that are kept in a folder and grow by batches of edges.

    ``members`` says under which label an id was filed when it first came, ``moved`` where a label went when components met; both only
    grow, a folder for each batch, and a small file, written last, says which batches count. A batch looks up the components of its
    own ends, finds the components of the small graph of these labels, files its new ids, and notes the labels that moved: no old
    edge is read again and no old row rewritten. A batch that was stopped is as if it had never begun.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        make_folder(spark, self.folder)

    def batches(self) -> list[str]:
        """The batches that count, in order."""
        saved = read_saved(self.spark, f"{self.folder}/batches.json")
        return json.loads(saved)["batches"] if saved else []

    def _read(self, name: str) -> DataFrame | None:
        paths = [f"{self.folder}/{name}/{b}" for b in self.batches()]
        return self.spark.read.parquet(*paths) if paths else None

    def _moved(self) -> DataFrame | None:
        """``label, component``: where labels that moved are now; the latest move counts."""
        moved = self._read("moved")
        return None if moved is None else moved.groupBy("label").agg(F.max_by("component", "batch").alias("component"))

    def labels(self, of: DataFrame | None = None) -> DataFrame | None:
        """``id, component`` of all ids, or of those that ``of`` has; none before the first batch."""
        members, moved = self._read("members"), self._moved()
        if members is None:
            return None
        some = members if of is None else members.join(of.select("id").distinct(), "id", "left_semi")
        return some.join(moved, "label", "left").select("id", F.coalesce("component", "label").alias("component"))

    def add(self, edges: DataFrame, batch: str, src: str = "src", dst: str = "dst") -> dict[str, int]:
        """Add a batch of edges; how many ``ends``, new ``members`` and ``moved`` labels it had. A batch that counts is not added again.
        Nulls in either column make no edge; an id that only meets itself is a component of one."""
        done = self.batches()
        if batch in done:
            return {"ends": 0, "members": 0, "moved": 0}
        with only(self.spark):
            own, _ = written(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u is not null and v is not null").distinct(), "batch")
            ends, _ = written(own.select(F.col("u").alias("id")).union(own.select("v")).distinct(), "ends")
            known = self.labels(ends)
            if known is None:
                known = ends.limit(0).withColumn("component", F.col("id"))
            known, _ = written(known, "known")
            placed, _ = written(ends.join(known, "id", "left").select("id", F.col("component").isNull().alias("new"), F.coalesce("component", "id").alias("component")), "placed")
            at = lambda end: placed.select(F.col("id").alias(end), F.col("component").alias(f"_{end}"))
            small = own.join(at("u"), "u").join(at("v"), "v").select(F.col("_u").alias("src"), F.col("_v").alias("dst"))
            found = connected_components(small.distinct())
            joined = found.select(F.col("id").alias("component"), F.col("component").alias("now"))
            now, _ = written(placed.join(joined, "component", "left").select("id", "new", "component", F.coalesce("now", "component").alias("now")), "now")
            number = F.lit(len(done)).alias("batch")
            members = now.filter("new").select("id", F.col("now").alias("label"))
            went, _ = written(now.filter("not new and now <> component").select("component", "now").distinct(), "went")
            again = went.select(F.col("component").alias("label"), F.col("now").alias("component"), number)
            moved = self._moved()
            if moved is not None:  # labels that had gone to a component that moves now
                again = again.union(moved.join(went, "component").select("label", "now", number))
            self._write("members", batch, members)
            self._write("moved", batch, again.distinct())
            counted = {"ends": ends.count(), **{name: self.spark.read.parquet(f"{self.folder}/{name}/{batch}").count() for name in ("members", "moved")}}
        write_text(self.spark, f"{self.folder}/batches.json", json.dumps({"batches": [*done, batch]}))
        return counted

    def _write(self, name: str, batch: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/{batch}")
