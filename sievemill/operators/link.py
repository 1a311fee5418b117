"""Lookups written as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import ids, urls
from sievemill.functions import text as X


def pending(targets: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Targets that are not done yet."""
    return targets.join(done.select(keys).distinct(), keys, "left_anti")


def completed_keys(rows: DataFrame, state: DataFrame, key: str = "key") -> DataFrame:
    """Keys of finished rows together with keys of the run's state."""
    return rows.select(key).union(state.select(key)).filter(F.col(key) != "").distinct()


def typed_keys(df: DataFrame) -> Column:
    """DOI, PMID, PMCID and title as one array of ``kind:value``, of those columns that there are."""
    has = lambda n: F.col(n) if n in df.columns else F.lit("")
    pairs = [("doi", ids.doi_matching(has("doi"))), ("pmid", X.drop_decimal_zero(has("pmid"))), ("pmcid", F.lower(X.clean(has("pmcid")))), ("title", X.normalize_title(has("title")))]
    return F.filter(F.array(*[F.when(v != "", F.concat(F.lit(f"{k}:"), v)) for k, v in pairs]), lambda k: k.isNotNull())


def flag_by_any_key(df: DataFrame, other: DataFrame, row_id: str, name: str = "is_match") -> DataFrame:
    """``df`` with whether any of its keys is also one of ``other``'s. Keys are exploded and met by equality, so an OR of four
    conditions is one hash join."""
    theirs = other.select(F.explode(typed_keys(other)).alias("_key")).distinct()
    hits = df.select(row_id, F.explode(typed_keys(df)).alias("_key")).join(theirs, "_key").select(row_id).distinct().withColumn(name, F.lit(True))
    return df.join(hits, row_id, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def benchmark_first(df: DataFrame, benchmark: DataFrame, pos: str) -> DataFrame:
    """Rows that the benchmark holds, then the others, each in order."""
    return flag_by_any_key(df, benchmark, pos, "is_benchmark").orderBy(F.desc("is_benchmark"), pos)


def restore_order(df: DataFrame, positions: DataFrame, key: str, pos: str) -> DataFrame:
    """Rows in the order of the targets, unmatched ones last."""
    return df.join(positions.groupBy(key).agg(F.min(pos).alias("_at")), key, "left").orderBy(F.asc_nulls_last("_at"), key).drop("_at")


def in_target_order(df: DataFrame, targets: DataFrame, key: str, pos: str, seq: str) -> DataFrame:
    """Rows of the targets in their order; of rows that repeat a key the last by ``seq`` wins."""
    return latest(df, key, seq).join(targets.select(key, F.col(pos).alias("_at")), key).orderBy("_at").drop("_at")


def audit_two_columns(df: DataFrame, url: str, evidence: str, pos: str, check) -> DataFrame:
    """Two address columns checked as one batch of distinct keys: every row with the result of its first address and, with
    ``evidence_`` before the names, of its second. ``check`` is as in ``fan_out``."""
    both = df.select(F.col(url).alias("u"), F.col(pos).alias("p"), F.lit(0).alias("s")).union(df.select(evidence, pos, F.lit(1))).withColumn("url_key", urls.url_key(F.col("u")))
    firsts = both.filter("url_key <> ''").groupBy("url_key").agg(F.min_by("u", F.struct("s", "p")).alias("url"))
    found = check(firsts)
    rest = [c for c in found.columns if c != "url_key"]
    own = df.withColumn("url_key", urls.url_key(F.col(url))).join(found, "url_key", "left").drop("url_key")
    theirs = found.select("url_key", *[F.col(c).alias(f"evidence_{c}") for c in rest])
    return own.withColumn("url_key", urls.url_key(F.col(evidence))).join(theirs, "url_key", "left").drop("url_key")


def append_columns(df: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """``df`` with the columns of a table that has a row for just each of its keys; another number of rows or other keys are an error."""
    n, m = df.count(), more.count()
    if n != m:
        raise ValueError(f"{n} rows, but {m} to append")
    out = df.join(more, key)
    if out.count() != n:
        raise ValueError(f"{key} differs")
    return out


def latest(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key, nulls in ``seq`` first."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("_row")).select(key, "_row.*")


def citation_expansion(seeds: DataFrame, edges: DataFrame, details: DataFrame) -> DataFrame:
    """One hop: the details of what the seeds cite."""
    return seeds.join(edges, "seed_pmid").join(details, ["ref_source", "ref_id"])


def max_by_lookup(df: DataFrame, row_id: str, cell: Column, cache: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The largest looked-up value of a cell's parts, null where none is known. ``cell``: an array; keys meet without case."""
    parts = df.select(row_id, F.explode(cell).alias("_part")).withColumn("_key", F.lower("_part"))
    known = cache.select(F.lower(F.col(key)).alias("_key"), value)
    best = parts.join(known, "_key").groupBy(row_id).agg(F.max(value).alias(name))
    return df.join(best, row_id, "left")


def fan_out(df: DataFrame, url: str, pos: str, check) -> DataFrame:
    """Check each distinct address key once, by its first spelling, and give every row the result. ``check``: DataFrame of
    ``url_key, url`` to one with ``url_key`` and result columns."""
    keyed = df.withColumn("url_key", urls.url_key(F.col(url)))
    firsts = keyed.filter("url_key <> ''").groupBy("url_key").agg(F.min_by(url, pos).alias("url"))
    return keyed.join(check(firsts), "url_key", "left")


def overlay(source: DataFrame, reviewed: DataFrame, key: str) -> DataFrame:
    """Reviewed rows replace source rows as a whole."""
    rest = [c for c in source.columns if c != key]
    theirs = reviewed.select(key, F.struct(*rest).alias("_new"))
    own = source.select(key, F.struct(*rest).alias("_old")).join(theirs, key, "left")
    return own.select(key, F.coalesce("_new", "_old").alias("_row")).select(key, "_row.*")


def enrich(df: DataFrame, audit: DataFrame, key: str, columns: list[str], flag: str = "agent_reviewed") -> DataFrame:
    """Columns of a left join, and yes or no for whether there was a row. A key that the right side repeats is an error."""
    twice = audit.groupBy(key).count().filter("count > 1").select(key).limit(1).collect()
    if twice:
        raise ValueError(f"{key} is repeated: {twice[0][0]}")
    return df.join(audit.select(key, *columns, F.lit("yes").alias(flag)), key, "left").withColumn(flag, F.coalesce(flag, F.lit("no")))


def prefix_columns(df: DataFrame, key: str, prefix: str) -> DataFrame:
    return df.select(key, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != key])


def changed_rows(before: DataFrame, after: DataFrame, pos: str, frozen: list[str], as_ids: tuple[str, ...] = ("id", "year")) -> DataFrame:
    """Positions and columns whose frozen cells differ, nulls counting as empty; ids and years are compared as ids, so 5 is 5.0."""
    text = lambda c, name: X.clean_id(F.col(name)) if c in as_ids else X.clean(F.col(name))
    new = after.select(F.col(pos), *[F.col(c).alias(f"_{c}") for c in frozen])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), text(c, c).alias("was"), text(c, f"_{c}").alias("now")) for c in frozen])
    both = before.select(pos, *frozen).join(new, pos, "full")
    return both.select(pos, F.explode(pairs).alias("c")).filter("c.was <> c.now").select(pos, "c.*")


def canonical_labels(label: str, mapping: dict[str, str], broad: dict[str, str] | None = None) -> Column:
    """A dimension's label for a raw one, else its broad group's, else the raw one in sentence case."""
    key = F.lower(X.collapse(F.col(label)))

    def look(table: dict[str, str] | None) -> Column:
        pairs = [F.lit(v) for kv in (table or {}).items() for v in kv]
        return F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None).cast("string")

    return F.coalesce(look(mapping), look(broad), X.sentence_case(F.col(label)))


def keys_of_groups(df: DataFrame, row_id: str, keys: Column) -> DataFrame:
    """Each row's keys with the smallest row that shares the key: the edges of the duplicate graph, without pairs. The smallest
    row comes from an aggregation, which meets the keys in a join that adaptive execution can split at a hot key."""
    exploded = df.select(F.col(row_id).alias("id"), F.explode(keys).alias("key")).distinct()
    return exploded.join(exploded.groupBy("key").agg(F.min("id").alias("first_id")), "key")
