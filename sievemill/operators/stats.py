"""Coverage statistics of a catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import tags
from sievemill.functions import text as X


def share(n: Column, total: int | Column) -> Column:
    return n / (F.lit(total) if isinstance(total, int) else total) * 100


def explode_labels(df: DataFrame, row_id: str, labels: Column) -> DataFrame:
    """``id, label``, each label once for each row."""
    return df.select(F.col(row_id).alias("id"), F.explode(labels).alias("label")).distinct()


def coverage(labels: DataFrame, total: int) -> DataFrame:
    """``label, n, pct``: distinct rows for each label; labels may overlap."""
    n = F.countDistinct("id")
    return labels.groupBy("label").agg(n.alias("n")).withColumn("pct", share(F.col("n"), total))


def top_with_unknown(counts: DataFrame, top: int, unknown: str = "Unknown") -> DataFrame:
    """The largest known labels, ties by name, then the unknown label whatever its rank: with ``rank``."""
    known = counts.filter(F.col("label") != unknown).orderBy(F.desc("n"), "label").limit(top)
    ranked = known.groupBy().agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "label", "n", "pct"))).alias("r"))  # at most ``top`` rows
    known = ranked.select(F.posexplode("r").alias("p", "x")).select((F.col("p") + 1).alias("rank"), "x.label", "x.n", "x.pct")
    rest = counts.filter(F.col("label") == unknown).select(F.lit(top + 1).alias("rank"), "label", "n", "pct")
    return known.unionByName(rest).orderBy("rank")


def exclusive(df: DataFrame, label: Column, total: int) -> DataFrame:
    """``label, n, pct`` of labels of which a row has one."""
    return df.groupBy(label.alias("label")).agg(F.count("*").alias("n")).withColumn("pct", share(F.col("n"), total))


def token_sets(df: DataFrame, column: str, labels: dict[str, str], other: str | None = None) -> DataFrame:
    """Rows with the label of their set of tokens; order and case of tokens don't matter. A set without a label has ``other``, or is
    an error where there is none: then the sets are looked over at once."""
    key = tags.set_key(tags.split_tags(F.col(column)))
    table = {tags_key(k): v for k, v in labels.items()}
    pairs = [F.lit(v) for kv in table.items() for v in kv]
    label = F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None).cast("string")
    if other is not None:
        return df.withColumn("label", F.coalesce(label, F.lit(other)))
    bad = df.filter(label.isNull()).select(key.alias("key")).distinct().orderBy("key").limit(5).collect()
    if bad:
        raise ValueError(f"{column} has sets without a label: {', '.join(r.key or '<blank>' for r in bad)}")
    return df.withColumn("label", label)


def tags_key(text: str) -> str:
    return ";".join(sorted({t.strip().lower() for t in text.split(";") if t.strip()}))


def how_many(df: DataFrame, column: str, unknown: str = "unknown") -> Column:
    """Unknown, Single or Multiple by the distinct tags of a cell besides the unknown one."""
    known = F.array_distinct(F.filter(tags.split_tags(F.col(column)), lambda t: F.lower(t) != unknown))
    return F.when(F.size(known) == 0, F.lit("Unknown")).when(F.size(known) == 1, F.lit("Single")).otherwise(F.lit("Multiple"))


def ordered(counts: DataFrame, categories: list[str]) -> DataFrame:
    """Counts in a fixed order of categories; a category that is missing is an error, as is one that is not listed."""
    order = counts.sparkSession.createDataFrame(list(enumerate(categories)), "position int, label string")
    joined = counts.join(F.broadcast(order), "label", "full")
    bad = joined.filter("position is null or n is null").select("label").limit(1).collect()
    if bad:
        raise ValueError(f"category does not fit: {bad[0][0]}")
    return joined.orderBy("position").drop("position")


def by_year(df: DataFrame, year: Column, total: int) -> DataFrame:
    """``label, n, pct, position``: every year from the first to the last, 0 where there is none, then Unknown."""
    years = df.select(year.cast("int").alias("y"))
    counts = years.groupBy("y").agg(F.count("*").alias("n"))
    span = counts.agg(F.min("y").alias("a"), F.max("y").alias("b")).filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("y"))
    known = span.join(counts, "y", "left").select(F.col("y").cast("string").alias("label"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.col("y").alias("position"))
    unknown = years.agg(F.sum(F.when(F.col("y").isNull(), 1).otherwise(0)).cast("bigint").alias("n")).select(F.lit("Unknown").alias("label"), F.coalesce("n", F.lit(0)).alias("n"), F.lit(1 << 30).alias("position"))
    return known.union(unknown).select("label", "n", share(F.col("n"), total).alias("pct"), "position")


def peak(years: DataFrame) -> DataFrame:
    """The year with the most rows, the first of several, and the range."""
    known = years.filter("label <> 'Unknown'")
    best = F.max_by("label", F.struct("n", -F.col("position")))
    return known.agg(best.alias("peak_year"), F.max("n").alias("peak_n"), F.max("pct").alias("peak_pct"), F.min("position").alias("first_year"), F.max("position").alias("last_year"))


def two_levels(labels: DataFrame, dimension: DataFrame, total: int) -> DataFrame:
    """Distinct rows for each code and for each major code, in the dimension's order, 0 where there is none. Labels may overlap, so a
    major is not the sum of its codes. ``dimension``: ``position, major_code, major_label, code, sub_label``."""
    subs = labels.groupBy(F.col("label").alias("code")).agg(F.countDistinct("id").alias("n"))
    majors = labels.join(dimension.select("code", "major_code").distinct(), labels.label == F.col("code")).groupBy("major_code").agg(F.countDistinct("id").alias("n"))
    low = dimension.select(F.lit("sub").alias("level"), "position", "code", F.col("sub_label").alias("name")).join(subs, "code", "left")
    tops = dimension.groupBy(F.col("major_code").alias("code")).agg(F.min("position").alias("position"), F.first("major_label").alias("name"))
    high = tops.join(majors.withColumnRenamed("major_code", "code"), "code", "left").select(F.lit("major").alias("level"), "position", "code", "name", "n")
    both = low.select("level", "position", "code", "name", "n").union(high)
    return both.withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint")).withColumn("pct", share(F.col("n"), total))


def unknown_codes(labels: DataFrame, dimension: DataFrame) -> DataFrame:
    """Codes that the dimension does not know."""
    return labels.select(F.col("label").alias("code")).distinct().join(dimension.select("code"), "code", "left_anti")


def fill_dimension(df: DataFrame, pos: str, layouts: list[dict[str, str]]) -> DataFrame:
    """A classification table with merged cells: columns renamed by the layout that fits, major cells filled downwards, incomplete rows
    dropped. Codes must be unique."""
    from .chunk import forward_fill

    fits = [m for m in layouts if set(m) <= set(df.columns)]
    if not fits:
        raise ValueError("no known layout")
    named = df.select(pos, *[F.col(a).alias(b) for a, b in fits[0].items()])
    filled = forward_fill(named, [], [pos], ["major_code", "major_label"])
    out = filled.dropna(subset=["major_code", "major_label", "code", "sub_label"])
    twice = out.groupBy("code").count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"code is repeated: {twice[0][0]}")
    return out


def rounded(df: DataFrame) -> DataFrame:
    """Shares with one decimal, halves to even."""
    return df.withColumn("pct", F.bround("pct", 1))


def yes_no_labels(df: DataFrame, column: str, yes: str = "Available", no: str = "Not available") -> DataFrame:
    """The table with ``label`` for a column of yes and no; any other value is an error."""
    value = F.lower(X.collapse(F.coalesce(F.col(column).cast("string"), F.lit(""))))
    bad = df.select(value.alias("v")).filter(~F.col("v").isin("yes", "no")).distinct().orderBy("v").limit(5).collect()
    if bad:
        raise ValueError(f"{column} has other values: {', '.join(r.v or '<blank>' for r in bad)}")
    return df.withColumn("label", F.when(value == "yes", F.lit(yes)).otherwise(F.lit(no)))


def live_or_dead(c: Column) -> Column:
    """Live for yes and live, Dead for anything else."""
    return F.when(F.lower(X.collapse(F.coalesce(c.cast("string"), F.lit("")))).isin("yes", "live"), F.lit("Live")).otherwise(F.lit("Dead"))
