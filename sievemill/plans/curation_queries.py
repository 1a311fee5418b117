"""Queries of validation, review and final candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.operators import catalog, summary, validate

from .registry import query, table


@query(
    """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 7 = 0 THEN 'ftp://x' ELSE 'https://e.org/' || o_orderkey END AS url,
  CASE WHEN o_orderkey % 11 = 0 THEN '2026-02-30' WHEN o_orderkey % 13 = 0 THEN '2026-7-1' ELSE '2026-07-01' END AS day, o_orderstatus AS status FROM orders)
SELECT o_orderkey AS row_pos, 'priority' AS "column", 'is blank' AS rule, priority AS value FROM o WHERE priority = ''
UNION ALL SELECT o_orderkey, 'url', 'invalid evidence URL', url FROM o WHERE url LIKE 'ftp%'
UNION ALL SELECT o_orderkey, 'statement', 'must have 20-300 characters', priority || url FROM o WHERE length(priority || url) < 20
UNION ALL SELECT o_orderkey, 'day', 'invalid evidence date', day FROM o WHERE day <> '2026-07-01'
UNION ALL SELECT o_orderkey, 'status', 'has invalid values', status FROM o WHERE status NOT IN ('F', 'O')
"""
)
def violations_report(spark, sf):
    k = F.col("o_orderkey")
    df = table(spark, sf, "orders").select(
        k,
        F.when(k % 10 == 0, F.lit(" ")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 7 == 0, F.lit("ftp://x")).otherwise(F.concat(F.lit("https://e.org/"), k)).alias("url"),
        F.when(k % 11 == 0, F.lit("2026-02-30")).when(k % 13 == 0, F.lit("2026-7-1")).otherwise(F.lit("2026-07-01")).alias("day"),
        F.col("o_orderstatus").alias("status"),
    )
    df = df.withColumn("statement", F.concat(F.trim("priority"), "url"))
    rules = [*validate.required_rules(["priority"]), *validate.evidence_rules("url", "statement", "day"), *validate.allowed_rules({"status": ["f", "o"]})]
    return validate.violations(df, "o_orderkey", "o_orderkey", rules).select("row_pos", "column", "rule", "value")


@query("SELECT quality AS grp, count(*) AS n, CAST(count_if(toxic = 1) AS BIGINT) AS manual, CAST(floor(count(*) * 0.05) AS BIGINT) AS chunk_limit, greatest(1, CAST(ceil(count(*) / 20.0) AS BIGINT)) AS final_limit, count_if(toxic = 1) > floor(count(*) * 0.05) AS exceeded FROM labels GROUP BY quality")
def manual_limit(spark, sf):
    rows = table(spark, sf, "labels").groupBy(F.col("quality").alias("grp")).agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("manual"))
    limits = rows.withColumns({"chunk_limit": validate.chunk_review_limits(F.col("n")), "final_limit": validate.final_review_limits(F.col("n"))})
    return limits.withColumn("exceeded", F.col("manual") > F.col("chunk_limit"))


def _reviewed(spark, sf):
    k = F.col("page_id")
    rows = table(spark, sf, "pages").select(
        k.alias("id"),
        F.when(k % 3 == 0, F.lit("dead")).otherwise(F.lit("live")).alias("accessibility"),
        F.when(k % 5 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("db_type_confirmation"),
        F.when(k % 4 == 0, F.lit("publication")).otherwise(F.lit("official_database")).alias("evidence_source_type"),
        F.when(k % 7 == 0, F.lit("primary")).when(k % 7 == 1, F.lit("Partial")).otherwise(F.lit("none")).alias("neural_link"),
        F.lit("https://www.a.org/x").alias("database_url"),
        F.when(k % 2 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("original48"),
    )
    audit = table(spark, sf, "pages").filter("page_id % 6 <> 5").select(
        k.alias("id"),
        F.when(k % 6 == 0, F.lit("restricted")).when(k % 6 == 1, F.lit("unreachable")).otherwise(F.lit("reachable")).alias("status"),
        F.when(k % 6 == 2, F.lit("http://b.org/")).otherwise(F.lit("http://a.org/")).alias("final_url"),
        F.when(k % 10 == 3, F.lit("unreachable")).otherwise(F.lit("reachable")).alias("evidence_status"),
        F.when(k % 50 == 9, F.lit("expired")).otherwise(F.lit("")).alias("tls_warning"),
    )
    groups = table(spark, sf, "pages").filter("page_id % 31 = 0").select(k.alias("id"), F.lit("dup_0001").alias("group"), F.lit("0;31").alias("members"))
    return rows, audit, groups


@query(
    """
SELECT page_id AS id, page_id % 5 = 0 OR (page_id % 6 <> 5 AND ((page_id % 6 <> 1) <> (page_id % 3 <> 0))) OR page_id % 6 = 0 OR (page_id % 6 <> 5 AND page_id % 10 = 3) OR (page_id % 3 <> 0 AND page_id % 4 = 0)
  OR page_id % 6 = 2 OR (page_id % 6 <> 5 AND page_id % 50 = 9) OR page_id % 31 = 0 AS needs_review FROM pages
"""
)
def review_queue(spark, sf):
    rows, audit, groups = _reviewed(spark, sf)
    return summary.review_queue(rows, groups, audit).select("id", "needs_review")


@query(
    """
WITH f AS (SELECT page_id FROM pages WHERE page_id % 3 <> 0 AND page_id % 5 = 0 AND page_id % 7 IN (0, 1))
SELECT 'rows' AS metric, count(*) AS value FROM pages UNION ALL SELECT 'removed', CAST(count_if(page_id % 31 = 0) AS BIGINT) FROM pages UNION ALL SELECT 'groups', 1 UNION ALL SELECT 'group_rows', CAST(count_if(page_id % 31 = 0) AS BIGINT) FROM pages
UNION ALL SELECT 'final', count(*) FROM f UNION ALL SELECT 'final_original', CAST(count_if(page_id % 2 = 0) AS BIGINT) FROM f
"""
)
def final_candidates(spark, sf):
    rows, _, groups = _reviewed(spark, sf)
    return summary.finalization_summary(rows, groups.select("id"), groups)


@query(
    """
SELECT CAST(sum(CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tag, CAST(sum(CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS url, CAST(sum(CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS doi FROM part
"""
)
def loader_changes(spark, sf):
    k = F.col("p_partkey")
    df = table(spark, sf, "part").select(
        F.when(k % 2 == 0, F.lit("Brain; brain;x")).otherwise(F.lit("Brain;x")).alias("tags"),
        F.when(k % 3 == 0, F.lit("n/a")).otherwise(F.lit("https://a.org")).alias("url"),
        F.when(k % 4 == 0, F.lit("doi:10.1000/x")).otherwise(F.lit("10.1000/x")).alias("doi"),
    )
    return catalog.changed_cells(df, {"tags": "t-word-tag", "url": "t-word-url", "doi": "t-word-doi"})


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN 'partial' WHEN p_partkey % 3 = 0 THEN 'none' ELSE 'primary' END AS neural_link FROM part")
def neural_consistency(spark, sf):
    k = F.col("p_partkey")
    df = table(spark, sf, "part").select("p_partkey", F.when(k % 3 == 0, F.lit("None")).otherwise(F.lit("primary")).alias("neural_link"), F.when(k % 2 == 0, F.lit("Renal cortex; Hippocampus")).otherwise(F.lit("kidney  cortex")).alias("tissue"))
    out = validate.consistent_neural_link(df, ["tissue"])
    return out.select("p_partkey", F.lower("neural_link").alias("neural_link"))
