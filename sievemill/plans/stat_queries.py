"""Queries of coverage statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.functions import text as X
from sievemill.operators import link, stats, summary

from .registry import query, table


@query(
    """
WITH l AS (SELECT DISTINCT p_partkey AS id, CASE WHEN w LIKE 's%' THEN 'Unknown' WHEN w = 'red' THEN 'Crimson' ELSE upper(w[1]) || w[2:] END AS label FROM (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS w FROM part) x WHERE w <> ''),
c AS (SELECT label, count(DISTINCT id) AS n, count(DISTINCT id) * 100.0 / (SELECT count(*) FROM part) AS pct FROM l GROUP BY label),
k AS (SELECT *, row_number() OVER (ORDER BY n DESC, label) AS rank FROM c WHERE label <> 'Unknown')
SELECT CAST(rank AS INTEGER) AS rank, label, n, round(pct, 6) AS pct FROM k WHERE rank <= 15 UNION ALL SELECT 16, label, n, round(pct, 6) FROM c WHERE label = 'Unknown'
"""
)
def coverage_topk_unknown(spark, sf):
    part = table(spark, sf, "part")
    words = part.select(F.col("p_partkey").alias("id"), F.explode(F.split(F.lower("p_name"), " ")).alias("w")).filter("w <> ''")
    label = F.when(F.col("w").startswith("s"), F.lit("Unknown")).otherwise(link.canonical_labels("w", {"red": "Crimson"}))
    labels = words.select("id", label.alias("label")).distinct()
    out = stats.top_with_unknown(stats.coverage(labels, part.count()), 15)
    return out.select("rank", "label", "n", F.round("pct", 6).alias("pct"))


@query("SELECT o_orderpriority AS label, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 6) AS pct FROM orders GROUP BY 1")
def exclusive_breakdown(spark, sf):
    orders = table(spark, sf, "orders")
    out = stats.exclusive(orders, F.col("o_orderpriority"), orders.count())
    return out.select("label", "n", F.round("pct", 6).alias("pct"))


@query(
    """
WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, array_to_string(list_sort(list_distinct(list(event_type))), ';') AS key, count(DISTINCT event_type) AS k FROM events GROUP BY 1, 2)
SELECT CASE WHEN key = 'click;view' THEN 'Browsing' WHEN key = 'click' THEN 'Clicks' ELSE 'Other' END AS label, CASE WHEN k = 1 THEN 'Single' ELSE 'Multiple' END AS breadth, count(*) AS n FROM s GROUP BY 1, 2
"""
)
def token_set_breakdown(spark, sf):
    cells = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_join(F.collect_list(F.upper("event_type")), "; ").alias("cell"))
    labelled = stats.token_sets(cells, "cell", {"view;click": "Browsing", "click": "Clicks"}, "Other")
    return labelled.groupBy("label", stats.how_many(labelled, "cell").alias("breadth")).agg(F.count("*").alias("n"))


_MONTH = "CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER)"


@query(
    f"""
WITH y AS (SELECT CASE WHEN o_orderkey % 9 = 0 OR year(o_orderdate) = 1994 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS y FROM orders),
s AS (SELECT unnest(range((SELECT min(y) FROM y), (SELECT max(y) FROM y) + 1)) AS y)
SELECT CAST(s.y AS VARCHAR) AS label, count(y.y) AS n, round(count(y.y) * 100.0 / (SELECT count(*) FROM y), 6) AS pct FROM s LEFT JOIN y ON y.y = s.y GROUP BY s.y
UNION ALL SELECT 'Unknown', count(*), round(count(*) * 100.0 / (SELECT count(*) FROM y), 6) FROM y WHERE y IS NULL
"""
)
def year_gapfill(spark, sf):
    orders = table(spark, sf, "orders")
    year = F.when((F.col("o_orderkey") % 9 != 0) & (F.year("o_orderdate") != 1994), F.year("o_orderdate"))
    return stats.by_year(orders, year, orders.count()).select("label", "n", F.round("pct", 6).alias("pct"))


@query("WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders GROUP BY 1) SELECT CAST((SELECT y FROM c ORDER BY n DESC, y LIMIT 1) AS VARCHAR) AS peak_year, max(n) AS peak_n, min(y) AS first_year, max(y) AS last_year FROM c")
def year_peak(spark, sf):
    orders = table(spark, sf, "orders")
    return stats.peak(stats.by_year(orders, F.year("o_orderdate"), orders.count())).select("peak_year", "peak_n", "first_year", "last_year")


@query(
    """
WITH d AS (SELECT n_nationkey AS position, CAST(n_regionkey AS VARCHAR) AS major, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey),
l AS (SELECT DISTINCT s_suppkey AS id, CAST(s_nationkey AS VARCHAR) AS code FROM supplier WHERE s_nationkey % 4 <> 0 UNION SELECT DISTINCT s_suppkey, CAST((s_nationkey + 1) % 25 AS VARCHAR) FROM supplier)
SELECT 'sub' AS level, d.code, d.name, count(DISTINCT l.id) AS n FROM d LEFT JOIN l ON l.code = d.code GROUP BY 2, 3
UNION ALL SELECT 'major', d.major, d.r_name, count(DISTINCT l.id) FROM d LEFT JOIN l ON l.code = d.code GROUP BY 2, 3
"""
)
def two_level_counts(spark, sf):
    nation, region, supplier = (table(spark, sf, t) for t in ("nation", "region", "supplier"))
    dimension = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("position"), F.col("n_regionkey").cast("string").alias("major_code"), F.col("r_name").alias("major_label"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("sub_label")
    )
    codes = F.array(F.when(F.col("s_nationkey") % 4 != 0, F.col("s_nationkey")), (F.col("s_nationkey") + 1) % 25)
    labels = stats.explode_labels(supplier, "s_suppkey", F.transform(F.array_compact(codes), lambda c: c.cast("string")))
    return stats.two_levels(labels, dimension, supplier.count()).select("level", "code", "name", "n")


@query(
    """
SELECT count(*) AS rows, CAST(count_if(event_type = 'view') AS BIGINT) AS n_yes, CAST(count_if(event_type = 'click') AS BIGINT) AS n_no, CAST(sum(CASE WHEN event_id % 5 = 0 THEN 0 ELSE CAST(trunc(value) AS BIGINT) END) AS BIGINT) AS tokens, 0::BIGINT AS absent FROM events
"""
)
def stage_summary(spark, sf):
    check = F.when(F.col("event_type") == "view", F.lit(" Yes")).when(F.col("event_type") == "click", F.lit("NO")).otherwise(F.lit(""))
    rows = table(spark, sf, "events").select(check.alias("AI_check"), F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("tokens"))
    return summary.classification_summary(rows, ["tokens", "absent"])


@query("SELECT w AS term, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) x WHERE w <> '' GROUP BY w ORDER BY n DESC, w LIMIT 20")
def term_frequency(spark, sf):
    return summary.term_frequencies(table(spark, sf, "part"), F.filter(F.split("p_name", " "), lambda w: w != ""))


@query("SELECT 'MED' AS ref_source, l_partkey AS ref_id, count(*) AS n FROM lineitem GROUP BY l_partkey HAVING count(*) > 1")
def reference_frequency(spark, sf):
    return summary.repeated_references(table(spark, sf, "lineitem").select(F.lit("MED").alias("ref_source"), F.col("l_partkey").alias("ref_id")))


@query("SELECT source AS value, count(*) AS n FROM documents GROUP BY source")
def histogram(spark, sf):
    return summary.histogram(table(spark, sf, "documents"), "source")


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE END AS flag FROM part")
def boolean_normalize(spark, sf):
    k = F.col("p_partkey") % 6
    raw = F.when(k == 0, F.lit(" YES")).when(k == 1, F.lit("f")).when(k == 2, F.lit("1.0")).when(k == 3, F.lit("0")).when(k == 4, F.lit("2"))
    return table(spark, sf, "part").select("p_partkey", X.flag(raw).alias("flag"))
