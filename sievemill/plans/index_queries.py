"""Queries of states that are kept and grow: bitmaps, indexes, components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sievemill.operators import rollup, trigram
from sievemill.operators.components import StoredComponents
from sievemill.sources.shared_tables import new_path

from .registry import query, table


@query(
    """
WITH l AS (SELECT DISTINCT p_partkey AS id, w AS code FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part UNION ALL SELECT p_partkey, p_brand FROM part) x WHERE w <> ''),
d AS (SELECT DISTINCT code, code[1] AS major FROM l WHERE code[1] <> 'B')
SELECT 'sub' AS level, d.code, count(DISTINCT l.id) AS n FROM d JOIN l USING (code) GROUP BY 2
UNION ALL SELECT 'major', d.major, count(DISTINCT l.id) FROM d JOIN l USING (code) GROUP BY 2
UNION ALL SELECT 'total', '', count(DISTINCT l.id) FROM d JOIN l USING (code)
"""
)
def bitmap_rollup(spark, sf):
    """Two days' labels of ``part``, each with its own state, merged and rolled up."""
    codes = F.concat(F.split("p_name", " "), F.array("p_brand"))
    labels = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.explode(codes).alias("label")).filter("label <> ''")
    days = [labels.filter("id % 3 = 0"), labels.filter("id % 3 <> 0")]
    states, numbers = [], None
    for day in days:
        numbers = rollup.numbered_rows(day, "id", numbers)
        states.append(rollup.label_state(day, numbers))
    major = F.substring("label", 1, 1)
    dimension = labels.filter(major != "B").select(F.col("label").alias("code"), major.alias("major_code")).distinct()
    return rollup.rolled_up(rollup.merged(*states), dimension)


_KEYWORDS = ["Mit LICEN_E", "th%an%the", "e w", "Qx"]


@query(" UNION ALL ".join(f"SELECT '{k}' AS keyword, doc_id FROM documents WHERE lower(text) LIKE '%{k.lower()}%' OR lower(source) LIKE '%{k.lower()}%'" for k in _KEYWORDS))
def search_trigram(spark, sf):
    """Keywords looked up in an index of ``documents``; the last one is too short for it and reads every block."""
    folder = new_path(spark, "trigrams")
    trigram.build(table(spark, sf, "documents").select("text", "source", "doc_id"), folder, ["doc_id"], spark.createDataFrame([("text", "main", 0), ("source", "expand", 1)], "column_name string, display_group string, order_index int"))
    return trigram.find_any(spark, folder, _KEYWORDS).select("keyword", "doc_id")


_STEPS = [(5, 17), (7, 23), (11, 1)]


@query(
    f"""
WITH RECURSIVE d AS ({" UNION ALL ".join(f"SELECT c_custkey AS u, c_custkey + {step} AS v FROM customer WHERE c_custkey % {every} = 0" for every, step in _STEPS)}),
e AS (SELECT u, v FROM d WHERE v IN (SELECT c_custkey FROM customer)),
b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r AS (SELECT u, u AS v FROM b UNION SELECT r.u, b.v FROM r JOIN b ON b.u = r.v)
SELECT u AS id, min(v) AS component FROM r GROUP BY u
"""
)
def incremental_components(spark, sf):
    """Components that three batches of edges between customers lead to, each added to what is stored."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("src"))
    stored = StoredComponents(spark, new_path(spark, "components"))
    for k, (every, step) in enumerate(_STEPS):
        edges = customers.filter(F.col("src") % every == 0).withColumn("dst", F.col("src") + step)
        stored.add(edges.join(customers.select(F.col("src").alias("dst")), "dst", "left_semi"), f"batch_{k}")
    return stored.labels()


_AGES = ["c_custkey % 4 = 0", "c_custkey % 4 = 1", "c_custkey % 4 > 1"]


@query(
    """
WITH g AS (SELECT c_mktsegment || c_nationkey AS name, c_custkey AS id FROM customer),
m AS (SELECT name, min(id) AS first, count(*) AS n, string_agg(CAST(id AS VARCHAR) || '.0', ';' ORDER BY id) AS members FROM g GROUP BY name HAVING count(*) > 1)
SELECT id || '.0' AS id, 'dup_' || lpad(CAST(dense_rank() OVER (ORDER BY first) AS VARCHAR), 4, '0') AS "group", members, n AS candidate_count FROM g JOIN m USING (name)
"""
)
def duplicate_text_ids(spark, sf):
    """Duplicate groups of ids that are texts, as catalogs are read: members and groups come in the order of numbers."""
    from sievemill.operators import resolve

    rows = reduce(lambda a, b: a.union(b), [table(spark, sf, "customer").filter(age) for age in _AGES])
    rows = rows.select(F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("id"), F.array(F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))).alias("names"))
    return resolve.duplicate_candidates(rows, "id", F.col("names"), None).select("id", "group", "members", "candidate_count")
