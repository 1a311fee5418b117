"""Deduplication by keys, candidate pools and forced rows. Order-dependent operators take the name of a position column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import ids
from sievemill.functions import text as X
from sievemill.sources.shared_tables import written


def keep_first(df: DataFrame, key: Column, order: list[Column], unique: list[str], keep_keyless: bool = False) -> DataFrame:
    """One row of each key, the first in ``order``, then by the columns ``unique``, which tell rows apart. ``keep_keyless``: rows with
    an empty key all stay; otherwise the empty key is one like others, and so is null.

    Keys are computed once and written as digests beside what orders the rows. Of each key the first place comes from an aggregation,
    so a hot key's rows meet only after partial aggregation; the rows that are not first, mostly few, then leave the table by an
    anti-join on ``unique``. Whole rows are neither aggregated nor sorted by key."""
    if keep_keyless:
        key = X.let(key, lambda k: F.when(k != "", k))
        digest = F.md5(key)
    else:
        digest = F.coalesce(F.md5(key), F.lit(""))
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*order, *map(F.col, unique)])])
    keyed, _ = written(df.select(digest.alias("_key"), rank.alias("_rank"), *unique), "keys")
    keyed = keyed.filter("_key is not null")
    firsts = keyed.groupBy("_key").agg(F.min("_rank").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    later = keyed.join(firsts, "_key").filter("_rank > _first").select(unique)
    return df.join(later, unique, "left_anti").select(df.columns)


def seed_articles(df: DataFrame, order: str, pos: str, limit: int | None = None, title: str = "title", cited: str = "citedByCount") -> DataFrame:
    """One article of each title, case and outer blanks aside: the most cited one (``citations``) or the first (``relevance``)."""
    if order not in ("citations", "relevance"):
        raise ValueError(f"unknown order: {order}")
    n = X.to_int(F.col(cited))
    best = [-n, F.col(pos)] if order == "citations" else [F.col(pos)]
    out = keep_first(df, X.title_key(F.col(title)), best, [pos])
    out = out.orderBy(*([n.desc(), F.col(pos)] if order == "citations" else [F.col(pos)]))
    return out if limit is None else out.limit(limit)


def reference_details(df: DataFrame, pos: str) -> DataFrame:
    """One record of each DOI, else PMID, else PMCID, else title, the most cited one; records without any stay."""
    n = X.to_int(F.col("citedByCount"))
    key = ids.dedup_key(F.col("doi"), F.col("pmid"), F.col("pmcid"), F.col("title"))
    return keep_first(df, key, [-n], [pos], keep_keyless=True).orderBy(n.desc(), F.col(pos))


def seed_pmids(df: DataFrame, pos: str, limit: int | None = None) -> DataFrame:
    """The first run of digits of each PMID, each once, in order."""
    found = df.select(F.regexp_extract(X.clean(F.col("pmid")), r"(\d+)", 1).alias("pmid"), F.col(pos)).filter("pmid <> ''")
    out = found.groupBy("pmid").agg(F.min(pos).alias(pos)).orderBy(pos)
    return out if limit is None else out.limit(limit)


def reference_targets(edges: DataFrame, pos: str, limit: int | None = None) -> DataFrame:
    """Distinct (source, id) of the edges that have both, in order."""
    both = edges.select(X.clean(F.col("ref_source")).alias("ref_source"), X.clean(F.col("ref_id")).alias("ref_id"), F.col(pos)).filter("ref_source <> '' and ref_id <> ''")
    out = both.groupBy("ref_source", "ref_id").agg(F.min(pos).alias(pos)).orderBy(pos)
    return out if limit is None else out.limit(limit)


def union_superset(*frames: DataFrame) -> DataFrame:
    """Union by name; columns that a side lacks are empty texts there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.fillna("")


def _identity(df: DataFrame, resource: bool = False) -> Column:
    col = lambda *names: X.first_identity_value(*[F.col(n) for n in names if n in df.columns])
    own = lambda doi, pmid, pmcid, title: ids.identity_key(doi, pmid, pmcid, title, col("resource_name", "database_name") if resource else None)
    # values are bound, not copied to each place that uses them
    return X.let(col("doi", "ref_doi"), lambda d: X.let(col("pmid"), lambda p: X.let(col("pmcid"), lambda c: X.let(col("title", "ref_title"), lambda t: own(d, p, c, t)))))


def candidate_pool(seed: DataFrame, detail: DataFrame, pos: str) -> DataFrame:
    """Details, then seeds, one row of each identity; rows without an identity all stay. ``pos`` tells the rows of a side apart."""
    both = union_superset(detail.withColumn("candidate_source", F.lit("citation")).withColumn("_side", F.lit(0)), seed.withColumn("candidate_source", F.lit("seed")).withColumn("_side", F.lit(1)))
    return keep_first(both, _identity(both), [], ["_side", pos], keep_keyless=True).drop("_side")


def forced_includes(base: DataFrame, forced: DataFrame, pos: str) -> DataFrame:
    """Base rows, then the forced rows whose identity neither the base nor an earlier forced row has."""
    known = base.select(_identity(base, True).alias("_key")).filter("_key <> ''").distinct()
    keyed, _ = written(forced.withColumn("_key", _identity(forced, True)), "forced")
    new = keep_first(keyed, F.col("_key"), [], [pos], keep_keyless=True)
    return union_superset(base, new.join(known, "_key", "left_anti").drop("_key"))


def duplicate_ids(df: DataFrame, key: str, pos: str) -> DataFrame:
    """Later rows of an id with the position where it was first seen. First places are aggregated by the id's digest; of ids that
    come once nothing is joined."""
    keyed = df.withColumn("_key", F.sha2(F.col(key).cast("string"), 256))
    firsts = keyed.groupBy("_key").agg(F.min(pos).alias("first_seen"), F.count("*").alias("_n")).filter("_n > 1 and _key is not null").drop("_n")
    return keyed.join(firsts, "_key").filter(F.col(pos) > F.col("first_seen")).select(*df.columns, "first_seen")
