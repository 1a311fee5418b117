"""Queries of operators that no other query exercises."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.functions import tags
from sievemill.functions import text as X
from sievemill.operators import link, screen, stats, validate

from .funnel import CURATION, FROZEN
from .registry import query, table

#: What a well curated row holds; the identity columns come from the table.
_CELLS = {
    "original48": "no", "policy_version": "v1", "accessibility": "live", "db_type_confirmation": "yes", "confirmation_reason": "ok", "qualification_basis": "splicing_event", "exclusion_code": "not_applicable",
    "evidence_url": "https://a.org/x", "evidence_source_type": "official_database", "evidence_statement": "a statement of twenty chars", "evidence_checked_date": "2026-07-01", "manual_review_needed": "no",
    "neural_link": "none", "focus": "as_focused", "gene_expression_available": "no", "species": "human", "disease_association": "unknown", "developmental_association": "unknown", "tissue_or_brain_region": "liver",
    "cell_type": "unknown", "sequencing_resolution": "bulk", "read_technology": "short", "visualization_methods": "browser",
}


@query(
    """
WITH n AS (SELECT count(*) AS n FROM documents)
SELECT 'a' AS chunk_id, 'pending' AS status, CAST(NULL AS BIGINT) AS input_rows, CAST(NULL AS BIGINT) AS result_rows, 'result is missing' AS error, 'v1' AS policy_version
UNION ALL SELECT 'b', 'complete', n, n, '', 'v1' FROM n
UNION ALL SELECT 'c', 'invalid', n, n, 'ids are in another order', 'v1' FROM n
UNION ALL SELECT 'd', 'invalid', n, n - 1, 'expected ' || n || ' rows, found ' || (n - 1), 'v1' FROM n
UNION ALL SELECT 'e', 'invalid', n, n, 'the input''s columns are not those of a curation table', 'v1' FROM n
UNION ALL SELECT 'f', 'invalid', n, n, 'title changed: ' || (SELECT lang FROM documents ORDER BY doc_id LIMIT 1) || ' to other', 'v1' FROM n
UNION ALL SELECT 'g', 'invalid', n, n, 'manual review limit exceeded: ' || (SELECT count(*) FROM documents WHERE doc_id % 10 = 0) || '/' || n || ' rows, maximum ' || CAST(floor(n * 0.05) AS BIGINT), 'v1' FROM n
"""
)
def chunk_reviews(spark, sf):
    docs = table(spark, sf, "documents")
    k = F.col("doc_id")
    first = docs.agg(F.min("doc_id")).first()[0]
    own = {"id": k.cast("string"), "title": F.col("lang"), "database_name": F.col("source"), "database_url": F.lit("https://a.org"), "doi": F.lit(""), "pmid": F.lit(""), "year": F.lit("2020")}
    whole = docs.select(k.alias("pos"), *[(own[c] if c in own else F.lit(_CELLS[c])).alias(c) for c in CURATION])
    later = whole.withColumn("id", F.concat("id", F.lit(".0")))  # the same ids in another spelling
    set_first = lambda c, v: whole.withColumn(c, F.when(F.col("pos") == first, F.lit(v)).otherwise(F.col(c)))
    no = {"db_type_confirmation": "no", "qualification_basis": "not_applicable", "exclusion_code": "insufficient_evidence", "focus": "unknown", "manual_review_needed": "yes"}
    unsure = whole.withColumns({c: F.when(F.col("pos") % 10 == 0, F.lit(v)).otherwise(F.col(c)) for c, v in no.items()})
    chunks = {
        "a": (whole, None),
        "b": (whole, later),
        "c": (whole, set_first("id", "x")),
        "d": (whole, whole.filter(F.col("pos") != first)),
        "e": (whole.drop("cell_type"), whole),
        "f": (whole, set_first("title", "other")),
        "g": (whole, unsure),
    }
    return validate.review_manifest(spark, chunks, None, "v1", lambda result, source: validate.validate_chunk(result, source, "pos", CURATION, FROZEN))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append_columns(spark, sf):
    orders = table(spark, sf, "orders")
    return link.append_columns(orders.select("o_orderkey", "o_orderstatus"), orders.select("o_orderkey", "o_totalprice"), "o_orderkey")


@query("SELECT event_id, 'Skipped' AS ai_check FROM events WHERE event_type = 'view'")
def skipped_of_yes(spark, sf):
    check = F.when(F.col("event_type") == "view", F.lit(" YES ")).when(F.col("event_type") == "click", F.lit("no"))
    yes = screen.yes_only(table(spark, sf, "events").select("event_id", check.alias("AI_check")))
    return screen.mark_skipped(yes).select("event_id", F.col("AI_check").alias("ai_check"))


@query("SELECT o_orderpriority AS label, count(*) AS n, round_even(count(*) * 100.0 / (SELECT count(*) FROM orders), 1)::DOUBLE AS pct FROM orders GROUP BY 1")
def rounded_shares(spark, sf):
    orders = table(spark, sf, "orders")
    return stats.rounded(stats.exclusive(orders, F.col("o_orderpriority"), orders.count()))


@query(
    """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE trim(c_name) END AS name, CASE c_custkey % 4 WHEN 0 THEN 'a|b|c' WHEN 1 THEN c_mktsegment WHEN 2 THEN '' ELSE 'x' END AS tags,
  CASE c_custkey % 4 WHEN 0 THEN 3 WHEN 2 THEN 0 ELSE 1 END AS n FROM customer
"""
)
def names_and_tags(spark, sf):
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, F.lit(" None ")).otherwise(F.concat(F.lit("\t"), "c_name", F.lit("  ")))
    cell = F.when(k % 4 == 0, F.lit(" a;; b ;c; ")).when(k % 4 == 1, F.col("c_mktsegment")).when(k % 4 == 3, F.lit("x ;"))
    own = tags.split_tags(cell)
    return table(spark, sf, "customer").select("c_custkey", X.clean_resource_name(name).alias("name"), F.array_join(own, "|").alias("tags"), F.size(own).alias("n"))
