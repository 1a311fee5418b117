"""Run summaries: counts, sums and histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import tags
from sievemill.functions import text as X


def histogram(df: DataFrame, column: str) -> DataFrame:
    """``value, n``, nulls kept."""
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))


def numeric_sum(df: DataFrame, column: str) -> Column:
    """Sum of what is a number, 0 for anything else or without the column."""
    return F.sum(X.to_int(F.col(column))) if column in df.columns else F.lit(0).cast("bigint")


def classification_summary(df: DataFrame, tokens: list[str]) -> DataFrame:
    """One row: rows, yes, no, and the sums of the token columns."""
    check = F.lower(X.clean(F.col("AI_check")))
    return df.agg(F.count("*").alias("rows"), F.count_if(check == "yes").alias("n_yes"), F.count_if(check == "no").alias("n_no"), *[F.coalesce(numeric_sum(df, c), F.lit(0)).alias(c) for c in tokens])


def chunk_summary(manifest: DataFrame) -> DataFrame:
    """One row: chunks by status, whether all are complete, and the pending ones."""
    status = F.col("status")
    waiting = F.filter(F.array_sort(F.collect_list(F.when(status != "complete", F.struct("chunk_id", "status")))), lambda x: x.isNotNull())
    return manifest.agg(F.count("*").alias("chunks"), F.count_if(status == "complete").alias("complete"), (F.count_if(status != "complete") == 0).alias("merge_ready"), waiting.alias("pending"))


def needs_review(known_groups: bool = True) -> Column:
    """Rows for a last look: a yes, disagreement of the automatic and the curated accessibility, addresses that refuse or lead elsewhere,
    evidence that fails, or certificate warnings."""
    live = F.lower(X.clean(F.col("accessibility"))) == "live"
    auto = F.col("status").isin("reachable", "restricted", "continue_required")
    host = lambda c: F.regexp_replace(F.regexp_extract(F.lower(X.clean(F.col(c))), r"^[a-z][a-z0-9+.\-]*://([^/?#:]*)", 1), r"^www\.", "")
    moved = (host("final_url") != "") & (host("final_url") != host("database_url"))
    rules = [
        F.lower(X.clean(F.col("db_type_confirmation"))) == "yes",
        F.col("status").isNotNull() & (auto != live),
        F.col("status").isin("restricted", "continue_required"),
        F.col("evidence_status") == "unreachable",
        live & (F.lower(X.clean(F.col("evidence_source_type"))) == "publication"),
        moved,
        X.clean(F.col("tls_warning")) != "",
    ]
    if known_groups:
        rules.append(F.col("group").isNotNull())
    return reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(False)) for r in rules])


def review_queue(df: DataFrame, duplicates: DataFrame, audit: DataFrame, row_id: str = "id") -> DataFrame:
    """Curated rows with their duplicate group and audit, and ``needs_review``."""
    joined = df.join(duplicates.select(row_id, "group", "members"), row_id, "left").join(audit, row_id, "left")
    return joined.withColumn("needs_review", needs_review())


def final_candidates(df: DataFrame) -> DataFrame:
    """Live rows decided yes with a neural link."""
    c = lambda n: F.lower(X.clean(F.col(n)))
    return df.filter((c("accessibility") == "live") & (c("db_type_confirmation") == "yes") & c("neural_link").isin("primary", "partial"))


def _metric(df: DataFrame, metric: str, value: Column) -> DataFrame:
    return df.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("value")).select(F.lit(metric).alias("metric"), "value")


def metrics(*rows: tuple[DataFrame, str, Column]) -> DataFrame:
    """``metric, value`` of aggregates over several tables."""
    return reduce(DataFrame.union, [_metric(*r) for r in rows])


def finalization_summary(df: DataFrame, removed: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Rows, rows removed, duplicate groups and their rows, final candidates and those of the original list."""
    final = final_candidates(df)
    n = F.count("*")
    original = F.count_if(F.lower(X.clean(F.col("original48"))) == "yes")
    return metrics((df, "rows", n), (removed, "removed", n), (duplicates, "groups", F.countDistinct("group")), (duplicates, "group_rows", n), (final, "final", n), (final, "final_original", original))


def loader_report(df: DataFrame, doi: str, tag_columns: list[str], accessible: str = "accessible") -> DataFrame:
    """Rows, rows with DOIs and with several, addresses that answer, fail or are missing, and distinct tags of each column."""
    n_doi, answers = F.size(tags.split_dois(F.col(doi))), F.col(accessible)
    rows = [(df, "rows", F.count("*")), (df, "doi_rows", F.count_if(n_doi > 0)), (df, "multi_doi_rows", F.count_if(n_doi > 1)), (df, "reachable", F.count_if(answers)), (df, "unreachable", F.count_if(~answers)), (df, "missing", F.count_if(answers.isNull()))]
    each = [(df.select(F.explode(F.transform(tags.split_tags(F.col(c)), F.lower)).alias("tag")), f"tags_{c}", F.countDistinct("tag")) for c in tag_columns]
    return metrics(*rows, *each)


def term_frequencies(df: DataFrame, terms: Column, top: int = 20) -> DataFrame:
    """The most frequent terms, ties by name."""
    return df.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(top)


def repeated_references(edges: DataFrame, least: int = 2) -> DataFrame:
    return edges.groupBy("ref_source", "ref_id").agg(F.count("*").alias("n")).filter(F.col("n") >= least).orderBy(F.desc("n"), "ref_source", "ref_id")


def class_histogram(df: DataFrame, column: str = "AI_class") -> DataFrame:
    """``value, n`` in the order of values, nulls kept and last."""
    number = F.col("value").try_cast("double")
    return histogram(df, column).orderBy(number.asc_nulls_last(), F.asc_nulls_last("value"))


def final_histograms(df: DataFrame, columns: tuple[str, ...] = ("accessibility", "db_type_confirmation", "neural_link", "evidence_source_type")) -> DataFrame:
    """``metric, value, n``: how often each value of the columns occurs, from one pass over the table."""
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("c")).groupBy("c.metric", "c.value").agg(F.count("*").alias("n"))
