"""Queries of validation rules, decisions, merges, small text forms and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.functions import ids, tags, urls
from sievemill.functions import text as X
from sievemill.operators import chunk, dedup, link, resolve, search, stats, summary, validate

from .registry import query, table

def _key():
    return F.col("o_orderkey")



@query("SELECT CAST(c_custkey % 50 AS VARCHAR) AS pmid, min(c_custkey) AS pos FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1")
def seed_pmids(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(k.alias("pos"), F.when(k % 7 != 0, F.concat(F.lit("PMID "), k % 50, F.lit(".0"))).alias("pmid"))
    return dedup.seed_pmids(rows, "pos")


@query("SELECT 'MED' AS ref_source, CAST(l_partkey AS VARCHAR) AS ref_id, min(l_orderkey * 10 + l_linenumber) AS pos FROM lineitem WHERE l_linenumber <> 7 GROUP BY l_partkey")
def reference_targets(spark, sf):
    source = F.when(F.col("l_linenumber") == 7, F.lit(" ")).otherwise(F.lit("MED "))
    edges = table(spark, sf, "lineitem").select(source.alias("ref_source"), F.concat(F.lit(" "), F.col("l_partkey").cast("string")).alias("ref_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    return dedup.reference_targets(edges, "pos")


_IDS = "WITH d AS (SELECT o_orderkey AS p, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE CAST(o_orderkey % 5000 AS VARCHAR) END AS id FROM orders), f AS (SELECT id, min(p) AS first FROM d WHERE id <> '' GROUP BY id)"


@query(_IDS + " SELECT p AS row_pos, id, 'is blank' AS rule FROM d WHERE id = '' UNION ALL SELECT p, d.id, 'is a duplicate; first seen at Excel row ' || (first + 2) FROM d JOIN f USING (id) WHERE p > first")
def id_violations(spark, sf):
    rows = table(spark, sf, "orders").select(_key().alias("p"), F.when(_key() % 11 == 0, F.lit(" ")).otherwise((_key() % 5000).cast("string")).alias("id"))
    return validate.id_violations(rows, "p", "id").select("row_pos", "id", "rule")


@query(
    """
SELECT o_orderkey AS row_pos, 'url' AS "column", 'invalid URL' AS rule FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'doi', 'invalid DOI' FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, 'price', 'not a number' FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT o_orderkey, 'cited', 'not a number' FROM orders WHERE o_orderkey % 17 = 0
UNION ALL SELECT o_orderkey, 'flag', 'not a boolean' FROM orders WHERE o_orderkey % 11 = 0
UNION ALL SELECT o_orderkey, 'words', 'forbidden separator' FROM orders WHERE o_orderkey % 13 = 0
"""
)
def loader_violations(spark, sf):
    pick = lambda n, bad, good: F.when(_key() % n == 0, F.lit(bad)).otherwise(good if not isinstance(good, str) else F.lit(good))
    rows = table(spark, sf, "orders").select(
        _key(), pick(3, "https:///x", "HTTPS://a.org/x").alias("url"), pick(5, "10.1/x", "10.1000/x;10.1000/y").alias("doi"), pick(7, "12a", F.col("o_totalprice").cast("string")).alias("price"),
        pick(17, "many", " ").alias("cited"), pick(11, "maybe", "Yes").alias("flag"), pick(13, "a, b", "a;b").alias("words"),
    )
    kinds = {"url": "t-word-url", "doi": "t-word-doi", "price": "t-numeric", "cited": "t-numeric-cite", "flag": "t-bool", "words": "t-word-tag"}
    return validate.violations(rows, "o_orderkey", "o_orderkey", validate.loader_rules(kinds)).select("row_pos", "column", "rule")


@query(
    """
SELECT p_partkey AS row_pos, 'id' AS "column", 'is blank' AS rule FROM part WHERE p_partkey % 41 = 0
UNION ALL SELECT p_partkey, 'name', 'is missing' FROM part WHERE p_partkey % 43 = 0
UNION ALL SELECT p_partkey, 'year', 'is not a whole number' FROM part WHERE p_partkey % 7 = 0
UNION ALL SELECT p_partkey, 'year', 'is out of range' FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 5 = 0
UNION ALL SELECT p_partkey, 'resolution', 'has unknown tags' FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, 'accessibility', 'has unknown values' FROM part WHERE p_partkey % 11 = 0
"""
)
def landscape_violations(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        k.alias("pos"),
        F.when(k % 41 != 0, k).alias("id"),
        F.when(k % 43 != 0, F.concat(F.col("p_name"), k.cast("string"))).alias("name"),
        F.when(k % 7 == 0, F.lit("2001.5")).when(k % 5 == 0, F.lit("1799")).otherwise(F.lit("2001.0")).alias("year"),
        F.when(k % 3 == 0, F.lit("bulk;spatial")).otherwise(F.lit("Single_cell; bulk")).alias("resolution"),
        F.lit("short").alias("read"),
        F.when(k % 11 == 0, F.lit("maybe")).otherwise(F.lit(" Live")).alias("accessibility"),
    )
    return validate.landscape_violations(rows, "pos", 2026).select("row_pos", "column", "rule")


def _curated(spark, sf):
    """Orders as curated rows, each broken in the way that its key says."""
    good = {
        "accessibility": "live", "db_type_confirmation": "yes", "confirmation_reason": "ok", "qualification_basis": "splicing_event", "exclusion_code": "not_applicable", "evidence_url": "https://a.org/x",
        "evidence_source_type": "official_database", "evidence_statement": "a statement of twenty chars", "evidence_checked_date": "2026-07-01", "manual_review_needed": "no", "neural_link": "none",
        "focus": "as_focused", "gene_expression_available": "no", "species": "human", "disease_association": "unknown", "developmental_association": "unknown", "tissue_or_brain_region": "liver",
        "cell_type": "unknown", "sequencing_resolution": "bulk", "read_technology": "short", "visualization_methods": "browser", "original48": "no",
    }
    broken = {1: ("species", " "), 2: ("confirmation_reason", "x" * 81), 3: ("read_technology", "short;long"), 4: ("disease_association", "Unclear"), 5: ("species", "none;human"), 6: ("cell_type", "Various cell types"), 7: ("qualification_basis", "splicing_event;splicing_event"), 8: ("evidence_checked_date", "2026-02-30"), 9: ("focus", "transcriptomics_general"), 10: ("db_type_confirmation", "no")}
    which = _key() % 12
    out = {}
    for c, value in good.items():
        e = F.lit(value)
        for k, (column, bad) in broken.items():
            if column == c:
                e = F.when(which == k, F.lit(bad)).otherwise(e)
        out[c] = e
    return table(spark, sf, "orders").select(_key().alias("pos"), _key().alias("id"), *[e.alias(c) for c, e in out.items()])


@query(
    """
WITH r(k, "column", rule) AS (VALUES (1, 'species', 'is blank'), (2, 'confirmation_reason', 'must have 1-80 characters'), (3, 'read_technology', 'has invalid values'), (4, 'disease_association', 'has forbidden values'),
  (4, 'disease_association', 'has forbidden values'), (5, 'species', 'has forbidden values'), (6, 'cell_type', 'has placeholder terms'), (7, 'qualification_basis', 'has invalid values'),
  (8, 'evidence_checked_date', 'invalid evidence date'), (9, 'db_type_confirmation', 'inconsistent yes decision'), (10, 'db_type_confirmation', 'inconsistent no decision'))
SELECT o_orderkey AS row_pos, "column", rule FROM orders JOIN r ON k = o_orderkey % 12
"""
)
def curation_violations(spark, sf):
    return validate.violations(_curated(spark, sf), "pos", "id", validate.curation_rules()).select("row_pos", "column", "rule")


@query(
    """
SELECT o_orderkey AS row_pos, 'dead evidence must be publication' AS rule FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'live evidence must be official' FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, 'none conflicts with neural metadata' FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, 'invalid visit status' FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT o_orderkey, 'a live resource decided yes has to be entered' FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, 'a dead resource decided yes has to be confirmed dead' FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'continue-required row lacks a click path' FROM orders WHERE o_orderkey % 11 = 0
UNION ALL SELECT o_orderkey, 'a resource behind a continue page has to be entered' FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 7 = 0 AND o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, 'the representative has to be a member and the canonical name given' FROM orders WHERE o_orderkey % 13 = 0
UNION ALL SELECT o_orderkey, 'live row lacks a checked URL' FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, 'review statement too short' FROM orders WHERE o_orderkey % 19 = 0
"""
)
def final_review_violations(spark, sf):
    k = _key()
    rows = table(spark, sf, "orders").select(
        k.alias("pos"), k.alias("id"), F.when(k % 3 == 0, F.lit("dead")).otherwise(F.lit("live")).alias("accessibility"), F.when(k % 3 == 1, F.lit("publication")).otherwise(F.lit("official_database")).alias("evidence_source_type"),
        F.lit("yes").alias("db_type_confirmation"), F.lit("splicing_event").alias("qualification_basis"), F.lit("not_applicable").alias("exclusion_code"), F.lit("no").alias("manual_review_needed"), F.lit("as_focused").alias("focus"),
        F.lit("no").alias("gene_expression_available"), F.lit("https://a.org/x").alias("evidence_url"), F.lit("a statement of twenty chars").alias("evidence_statement"), F.lit("2026-02-30").alias("evidence_checked_date"), F.lit("none").alias("neural_link"),
        F.when(k % 5 == 0, F.lit("kidney cortex; Hippocampus")).otherwise(F.lit("Renal  cortex")).alias("tissue"), F.when(k % 7 == 0, F.lit("seen")).otherwise(F.lit("Entered_database")).alias("visit_status"),
        F.when(k % 11 == 0, F.lit("continue_required")).otherwise(F.lit("reachable")).alias("automatic_status"), F.lit("").alias("click_path"), F.lit("name").alias("canonical"), F.concat(k.cast("string"), F.lit(";0")).alias("members"),
        F.when(k % 13 == 0, F.lit("x")).otherwise(F.concat(k.cast("string"), F.lit(".0"))).alias("representative"), F.when(k % 17 == 0, F.lit("a.org")).otherwise(F.lit("https://a.org")).alias("checked_url"),
        F.when(k % 19 == 0, F.lit("short")).otherwise(F.lit("it was entered and looked at")).alias("review_statement"),
    )
    rules = [*validate.final_evidence_rules(), *validate.final_decision_rules(["tissue"]), *validate.visit_rules()]
    return validate.violations(rows, "pos", "id", rules).select("row_pos", "rule")


def _decided(spark, sf):
    """Customers in groups of a nation and segment, decided on in ways that the nation says."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    group = F.concat(n.cast("string"), F.lit("-"), F.col("c_mktsegment"))
    rows = table(spark, sf, "customer").select(k.cast("string").alias("id"), group.alias("group"), n.alias("n"))
    first = rows.groupBy("group").agg(F.min(F.col("id").cast("long")).cast("string").alias("first"))
    rows = rows.join(first, "group")
    merge = F.col("n") % 2 == 0
    return rows.select(
        "group", "id", F.when(F.col("n") == 3, F.lit("drop")).when(merge, F.lit("merge")).otherwise(F.lit("split")).alias("action"),
        F.when(merge, F.lit("A")).otherwise(F.concat(F.lit("n"), "id")).alias("canonical"), F.when(F.col("n") == 4, F.lit("0")).when(merge, F.col("first")).otherwise(F.col("id")).alias("representative"),
    )


@query(
    """
WITH g AS (SELECT DISTINCT c_nationkey AS n, c_nationkey || '-' || c_mktsegment AS "group" FROM customer)
SELECT "group", 'unknown_action' AS rule FROM g WHERE n = 3 UNION ALL SELECT "group", 'foreign_representative' FROM g WHERE n = 4
"""
)
def decision_checks(spark, sf):
    return resolve.check_decisions(_decided(spark, sf))


@query(
    """
WITH c AS (SELECT c_custkey AS id, c_nationkey || '-' || c_mktsegment AS grp, c_nationkey AS n FROM customer),
g AS (SELECT grp, n, list_transform(list_sort(list(id)), lambda i: CAST(i AS VARCHAR)) AS ids, min(id) AS first FROM c WHERE n % 2 = 0 GROUP BY 1, 2
  UNION ALL SELECT grp, n, [CAST(id AS VARCHAR)], id FROM c WHERE n % 2 = 1)
SELECT grp AS group_key, CASE WHEN n = 4 THEN '0' ELSE CAST(first AS VARCHAR) END AS representative, array_to_string(ids, ';') AS member_ids,
  array_to_string(list_filter(ids, lambda i: n = 4 OR i <> CAST(first AS VARCHAR)), ';') AS removed_ids, len(ids) AS member_count, CASE WHEN n = 4 THEN 'representative is no member' END AS rule FROM g
"""
)
def canonical_groups(spark, sf):
    rows = _decided(spark, sf)
    nation, segment = F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    candidates = table(spark, sf, "customer").select(F.concat(nation, F.lit("-"), segment).alias("group"), F.col("c_custkey").cast("string").alias("id"))
    out = resolve.canonical_groups(rows.withColumn("original48", F.lit("no")), candidates=candidates)
    return out.select("group_key", "representative", "member_ids", "removed_ids", "member_count", "rule")


@query(
    """
WITH RECURSIVE e AS (SELECT a.c_custkey AS u, b.c_custkey AS v FROM customer a JOIN customer b ON (a.c_custkey % 100 = b.c_custkey % 100 AND a.c_custkey % 3 = 0 AND b.c_custkey % 3 = 0) OR (a.c_custkey % 70 = b.c_custkey % 70 AND a.c_custkey % 5 = 0 AND b.c_custkey % 5 = 0)),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON e.u = r.v),
c AS (SELECT u AS id, min(v) AS first, string_agg(CAST(v AS VARCHAR), ';' ORDER BY v) AS members FROM r GROUP BY u HAVING count(*) > 1)
SELECT CAST(id AS VARCHAR) AS id, members, 'incremental_dup_' || lpad(CAST(dense_rank() OVER (ORDER BY first) AS VARCHAR), 4, '0') AS "group" FROM c
"""
)
def incremental_groups(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(k.cast("string").alias("id"))
    names = rows.filter("id % 3 = 0").select("id", (F.col("id").cast("int") % 100).cast("string").alias("name"))
    groups = rows.filter("id % 5 = 0").select("id", (F.col("id").cast("int") % 70).cast("string").alias("group"))
    return resolve.incremental_groups(rows, names, groups).select("id", "group", "members")


@query("SELECT d.doc_id, l.quality, CASE WHEN l.doc_id IS NULL THEN 'no' ELSE 'yes' END AS agent_reviewed FROM documents d LEFT JOIN labels l USING (doc_id)")
def enrich_audit(spark, sf):
    return link.enrich(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id", ["quality"])


@query("SELECT p_partkey, 'p_brand' AS \"column\", p_brand AS was, 'other' AS now FROM part WHERE p_partkey % 9 = 0 UNION ALL SELECT p_partkey, 'p_type', p_type, '' FROM part WHERE p_partkey % 14 = 0")
def changed_frozen_cells(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    k = F.col("p_partkey")
    after = part.select(k, F.when(k % 9 == 0, F.lit(" other")).otherwise(F.col("p_brand")).alias("p_brand"), F.when(k % 14 != 0, F.col("p_type")).alias("p_type"))
    return link.changed_rows(part, after, "p_partkey", ["p_brand", "p_type"])


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS x, CAST(NULL AS VARCHAR) AS y FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT CAST(s_suppkey AS VARCHAR), NULL, s_name FROM supplier WHERE s_suppkey % 2 = 1")
def merge_chunks(spark, sf):
    rows = table(spark, sf, "supplier")
    one = rows.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("x"))
    return chunk.merge_chunks([one, rows.filter("s_suppkey % 2 = 1").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("y"))], "id")


@query("SELECT count(*) AS chunks, CAST(count_if(s_suppkey % 4 <> 0) AS BIGINT) AS complete, count_if(s_suppkey % 4 = 0) = 0 AS merge_ready, CAST(count_if(s_suppkey % 4 = 0) AS INTEGER) AS n_pending FROM supplier")
def chunk_summary(spark, sf):
    k = F.col("s_suppkey")
    manifest = table(spark, sf, "supplier").select(k.alias("chunk_id"), F.when(k % 4 == 0, F.lit("invalid")).otherwise(F.lit("complete")).alias("status"))
    return summary.chunk_summary(manifest).select("chunks", "complete", "merge_ready", F.size("pending").alias("n_pending"))


@query(
    """
SELECT 'rows' AS metric, count(*) AS value FROM part UNION ALL SELECT 'doi_rows', CAST(count_if(p_partkey % 3 <> 0) AS BIGINT) FROM part UNION ALL SELECT 'multi_doi_rows', CAST(count_if(p_partkey % 3 = 1) AS BIGINT) FROM part
UNION ALL SELECT 'reachable', CAST(count_if(p_partkey % 4 = 0) AS BIGINT) FROM part UNION ALL SELECT 'unreachable', CAST(count_if(p_partkey % 4 = 1) AS BIGINT) FROM part
UNION ALL SELECT 'missing', CAST(count_if(p_partkey % 4 > 1) AS BIGINT) FROM part UNION ALL SELECT 'tags_p_type', count(DISTINCT lower(p_type)) FROM part
"""
)
def loader_report(spark, sf):
    k = F.col("p_partkey")
    doi = F.when(k % 3 == 1, F.lit("10.1000/a;10.1000/b;10.1000/A")).when(k % 3 == 2, F.lit("10.1000/a"))
    rows = table(spark, sf, "part").select(doi.alias("doi"), "p_type", F.when(k % 4 == 0, F.lit(True)).when(k % 4 == 1, F.lit(False)).alias("accessible"))
    return summary.loader_report(rows, "doi", ["p_type"])


@query("SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 1")
def ordered_categories(spark, sf):
    orders = table(spark, sf, "orders")
    known = [r[0] for r in orders.select("o_orderstatus").distinct().orderBy(F.desc("o_orderstatus")).collect()]  # a few statuses
    return stats.ordered(stats.exclusive(orders, F.col("o_orderstatus"), orders.count()), known).select("label", "n")


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS key FROM orders UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 2 = 0")
def completed_keys(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("key"))
    state = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise(F.lit("")).alias("key"))
    return link.completed_keys(rows, state)


@query("SELECT 'x' || p_type AS code FROM part WHERE p_partkey % 5 = 0 GROUP BY 1")
def unknown_codes(spark, sf):
    k = F.col("p_partkey")
    labels = table(spark, sf, "part").select(k.alias("id"), F.when(k % 5 == 0, F.concat(F.lit("x"), "p_type")).otherwise(F.col("p_type")).alias("label"))
    return stats.unknown_codes(labels, table(spark, sf, "part").select(F.col("p_type").alias("code")).distinct())


@query("SELECT CASE WHEN event_id % 10 = 9 THEN NULL ELSE CAST(event_id % 7 AS VARCHAR) END AS value, count(*) AS n FROM events GROUP BY 1")
def class_histogram(spark, sf):
    k = F.col("event_id")
    return summary.class_histogram(table(spark, sf, "events").select(F.when(k % 10 != 9, k % 7).alias("AI_class")))


@query("SELECT 'p_brand' AS metric, p_brand AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY 2")
def final_histograms(spark, sf):
    return summary.final_histograms(table(spark, sf, "part"), ("p_brand", "p_type"))


@query("SELECT CASE WHEN toxic = 1 THEN 'Available' ELSE 'Not available' END AS label, CASE WHEN quality = 1 THEN 'Live' ELSE 'Dead' END AS access, count(*) AS n FROM labels GROUP BY 1, 2")
def yes_no_breakdown(spark, sf):
    rows = table(spark, sf, "labels").select(F.when(F.col("toxic") == 1, F.lit(" YES")).otherwise(F.lit("no")).alias("c"), F.when(F.col("quality") == 1, F.lit("Live ")).otherwise(F.lit("gone")).alias("a"))
    return stats.yes_no_labels(rows, "c").groupBy("label", stats.live_or_dead(F.col("a")).alias("access")).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, max(l_linenumber) AS l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY l_orderkey")
def in_target_order(spark, sf):
    targets = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), (-_key()).alias("at"))
    return link.in_target_order(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), targets, "l_orderkey", "at", "l_linenumber")


@query("SELECT page_id, length(lower(url)) AS n, length('http://b.org/' || (page_id % 5)) AS evidence_n FROM pages")
def audit_two_columns(spark, sf):
    k = F.col("page_id")
    rows = table(spark, sf, "pages").select(k, F.concat(F.lit("https://a.org/"), k).alias("url"), F.length(F.lower("url")).alias("want"), F.concat(F.lit("http://b.org/"), k % 5).alias("evidence"))
    lengths = rows.select(urls.url_key(F.col("url")).alias("url_key"), "want")
    check = lambda firsts: firsts.join(lengths, "url_key", "left").select("url_key", F.coalesce("want", F.length("url")).cast("bigint").alias("n"))
    return link.audit_two_columns(rows, "url", "evidence", "page_id", check).select("page_id", "n", "evidence_n")


@query(
    """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN CAST(c_nationkey AS VARCHAR) WHEN 1 THEN 'A7' WHEN 2 THEN '' ELSE '4.5' END AS whole, CASE c_custkey % 4 WHEN 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS year,
  CASE WHEN c_custkey % 4 = 2 THEN c_name ELSE 'first' END AS first_value, 'Database URL Of' AS header, upper(c_mktsegment[1]) || c_mktsegment[2:] AS sentence, 'MED/' || c_custkey AS detail,
  CASE c_custkey % 3 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Accessible' ELSE 'Not accessible' END AS access, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN TRUE ELSE FALSE END AS accessible,
  'https://doi.org/10.1/' || c_custkey AS link, upper(sha256(c_name)) AS digest FROM customer
"""
)
def text_forms(spark, sf):
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    raw = F.when(k % 4 == 0, F.concat(n, F.lit(".0"))).when(k % 4 == 1, F.lit("A7")).when(k % 4 == 2, F.lit("None")).otherwise(F.lit("4.5"))
    status = F.when(k % 3 == 0, F.lit("missing")).when(k % 3 == 1, F.lit("restricted")).otherwise(F.lit("unreachable"))
    return table(spark, sf, "customer").select(
        "c_custkey", X.clean_int_identifier(raw).alias("whole"), X.clean_year(raw).alias("year"), X.first_identity_value(F.lit("N/A"), F.when(k % 4 != 2, F.lit("first")), F.col("c_name")).alias("first_value"),
        X.column_header(F.lit("database_url_of")).alias("header"), X.sentence_case(F.concat(F.lit("  "), F.col("c_mktsegment"))).alias("sentence"), ids.article_detail_key(F.lit("MED"), F.lit(" "), k, F.lit("x")).alias("detail"),
        search.access_label(F.when(k % 3 == 1, F.lit("1")).when(k % 3 == 2, F.lit("0"))).alias("access"), urls.accessible(status).alias("accessible"),
        F.array_join(tags.doi_links(F.concat(F.lit("10.1/"), k, F.lit("; "))), " ").alias("link"), X.upper_sha256(F.col("c_name")).alias("digest"),
    )
