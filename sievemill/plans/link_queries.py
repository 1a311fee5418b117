"""Queries of lookups, searches, chunks, resolution and parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.functions import model_output
from sievemill.functions import text as X
from sievemill.operators import chunk, link, resolve
from sievemill.operators import search as S

from .registry import query, table


@query(
    """
WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'd' || o_custkey END AS doi, CASE WHEN o_orderkey % 3 = 1 THEN o_custkey END AS pmid,
  CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) || (o_custkey % 40) END AS title FROM orders),
b AS (SELECT 'd' || c_custkey AS doi, c_custkey + 5 AS pmid, 'x' || c_custkey AS t FROM customer WHERE c_custkey % 10 = 0)
SELECT o_orderkey, (doi IS NOT NULL AND doi IN (SELECT doi FROM b)) OR (pmid IS NOT NULL AND pmid IN (SELECT pmid FROM b)) OR coalesce(title = '1-urgent0', false) AS is_benchmark FROM o
"""
)
def benchmark_priority(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, sf, "orders").select(
        k,
        F.when(k % 3 == 0, F.concat(F.lit("https://doi.org/D"), c)).alias("doi"),
        F.when(k % 3 == 1, F.concat(c.cast("string"), F.lit(".0"))).alias("pmid"),
        F.when(k % 2 == 0, F.concat(F.lit(" "), "o_orderpriority", (c % 40).cast("string"), F.lit(" ."))).alias("title"),
    )
    b = table(spark, sf, "customer").filter("c_custkey % 10 = 0").select(F.concat(F.lit("d"), "c_custkey").alias("doi"), (F.col("c_custkey") + 5).cast("string").alias("pmid"), F.lit("1-URGENT0").alias("title"))
    return link.benchmark_first(rows, b, "o_orderkey").select("o_orderkey", "is_benchmark")


@query(
    """
WITH u AS (SELECT l_orderkey, l_partkey FROM lineitem), p AS (SELECT p_partkey, p_retailprice FROM part WHERE p_partkey % 3 <> 0)
SELECT o_orderkey, max(p_retailprice) AS best FROM orders LEFT JOIN u ON l_orderkey = o_orderkey LEFT JOIN p ON l_partkey = p_partkey GROUP BY o_orderkey
"""
)
def citation_max(spark, sf):
    cells = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))), ";").alias("cell"))
    rows = table(spark, sf, "orders").select("o_orderkey").join(cells, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    cache = table(spark, sf, "part").filter("p_partkey % 3 <> 0").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("key"), "p_retailprice")
    cell = F.split(F.coalesce("cell", F.lit("")), ";")
    return link.max_by_lookup(rows, "o_orderkey", cell, cache, "key", "p_retailprice", "best").select("o_orderkey", "best")


@query(
    """
SELECT o.o_orderkey AS seed, count(*) AS n_edges, count(DISTINCT l.l_partkey) AS n_targets, CAST(sum(p.p_size) AS BIGINT) AS total_size
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1
"""
)
def citation_expansion(spark, sf):
    seeds = table(spark, sf, "orders").select(F.col("o_orderkey").alias("seed_pmid"))
    edges = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("seed_pmid"), F.lit("MED").alias("ref_source"), F.col("l_partkey").alias("ref_id"))
    details = table(spark, sf, "part").select(F.lit("MED").alias("ref_source"), F.col("p_partkey").alias("ref_id"), "p_size")
    out = link.citation_expansion(seeds, edges, details)
    return out.groupBy(F.col("seed_pmid").alias("seed")).agg(F.count("*").alias("n_edges"), F.countDistinct("ref_id").alias("n_targets"), F.sum("p_size").alias("total_size"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def manifest_latest(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return link.latest(rows, "user_id", "event_id")


@query(
    """
SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'reviewed' ELSE d.source END AS source, CASE WHEN l.doc_id IS NOT NULL THEN NULL ELSE d.lang END AS lang
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""
)
def overlay_reviewed(spark, sf):
    reviewed = table(spark, sf, "labels").select("doc_id", F.lit("reviewed").alias("source"), F.lit(None).cast("string").alias("lang"))
    return link.overlay(table(spark, sf, "documents").select("doc_id", "source", "lang"), reviewed, "doc_id")


# ---- searches

_VISIBLE = "p_partkey, p_name, p_brand, p_size"


def _catalog(spark, sf):
    df = table(spark, sf, "part").withColumn("main_collection", F.when(F.col("p_partkey") % 3 == 0, F.lit(" Yes ")))
    meta = spark.createDataFrame([("p_partkey", "main", 0), ("p_name", "main", 1), ("p_brand", "expand", 2), ("p_size", "main", 3), ("p_type", "hidden", 4), ("p_retailprice", "hidden", 5)], "column_name string, display_group string, order_index int")
    return df, meta


_LIKE = "(CAST(p_partkey AS VARCHAR) LIKE '%{0}%' OR lower(p_name) LIKE '%{0}%' OR lower(p_brand) LIKE '%{0}%' OR CAST(p_size AS VARCHAR) LIKE '%{0}%')"


@query(f"SELECT {_VISIBLE} FROM part WHERE {_LIKE.format('a_d#1')} OR {_LIKE.format('brand#1')}")
def search_keyword(spark, sf):
    df, meta = _catalog(spark, sf)
    one = S.search(df, S.Request("A_D#1"), meta)
    return one.union(S.search(df, S.Request("Brand#1"), meta)).distinct()


@query(f"SELECT {_VISIBLE} FROM part WHERE {_LIKE.format('1')} AND p_partkey % 3 = 0")
def search_main(spark, sf):
    df, meta = _catalog(spark, sf)
    return S.search(df, S.Request("1", "main"), meta)


@query(
    """
SELECT p_partkey FROM part WHERE list_contains(string_split(lower(p_name), ' '), lower(string_split((SELECT min(p_name) FROM part), ' ')[1])) AND p_size % 3 = 1
"""
)
def filter_tags_bools(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.array_join(F.split("p_name", " "), "; ").alias("words"), F.when(F.col("p_size") % 3 == 1, F.lit("True")).when(F.col("p_size") % 3 == 2, F.lit("0")).alias("flag"))
    tag = table(spark, sf, "part").agg(F.min("p_name")).first()[0].split(" ")[0]
    return S.search(df, S.Request(tags={"words": f" {tag.upper()} "}, flags={"flag": True}), None).select("p_partkey")


@query(
    """
SELECT o_orderkey, v FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS v FROM orders) x
ORDER BY v DESC NULLS LAST, o_orderkey LIMIT 10
"""
)
def numeric_sort_topn(spark, sf):
    v = F.when(F.col("o_orderkey") % 4 == 0, F.lit("n/a")).otherwise(F.round("o_totalprice", 2).cast("string"))
    out = S.search(table(spark, sf, "orders").select("o_orderkey", v.alias("v")), S.Request(sort="v", descending=True, top=10), None, "o_orderkey")
    return out.select("o_orderkey", F.col("v").try_cast("double").alias("v"))


# ---- chunks


@query(
    """
WITH c AS (SELECT user_id, event_id, event_type, CASE WHEN event_type = lag(event_type) OVER w OR lag(event_id) OVER w IS NULL THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM c)
SELECT user_id, event_id, CAST(run AS BIGINT) AS run, CAST(floor((row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) - 1) / 2) AS BIGINT) AS batch_in_run FROM r
"""
)
def run_batches(spark, sf):
    out = chunk.run_batches(table(spark, sf, "events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"], "event_type", 2)
    return out.select("user_id", "event_id", "run", "batch_in_run")


@query("SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY n_chars, doc_id) - 1) / 25) + 1 AS BIGINT) AS chunk_id FROM documents")
def fixed_chunks(spark, sf):
    return chunk.fixed_chunks(table(spark, sf, "documents").select("doc_id", "n_chars"), ["n_chars", "doc_id"], 25).select("doc_id", "chunk_id")


@query(
    """
WITH RECURSIVE g AS (SELECT doc_id, lang AS lane, CASE WHEN doc_id % 5 = 0 THEN 'r' || doc_id ELSE 'g' || (doc_id % 97) END AS unit FROM documents),
u AS (SELECT lane, unit, min(doc_id) AS pos, count(*) AS n FROM g GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY pos) AS k FROM u),
f AS (
  SELECT lane, k, unit, 1 AS chunk, CASE WHEN n >= 25 THEN 2 ELSE 1 END AS next, CASE WHEN n >= 25 THEN 0 ELSE n END AS n_rows FROM o WHERE k = 1
  UNION ALL
  SELECT o.lane, o.k, o.unit, CASE WHEN f.n_rows = 0 OR f.n_rows + o.n <= 25 THEN f.next ELSE f.next + 1 END,
    CASE WHEN f.n_rows = 0 OR f.n_rows + o.n <= 25 THEN f.next ELSE f.next + 1 END + CASE WHEN (CASE WHEN f.n_rows = 0 OR f.n_rows + o.n <= 25 THEN f.n_rows + o.n ELSE o.n END) >= 25 THEN 1 ELSE 0 END,
    CASE WHEN (CASE WHEN f.n_rows = 0 OR f.n_rows + o.n <= 25 THEN f.n_rows + o.n ELSE o.n END) >= 25 THEN 0 ELSE (CASE WHEN f.n_rows = 0 OR f.n_rows + o.n <= 25 THEN f.n_rows + o.n ELSE o.n END) END
  FROM f JOIN o ON o.lane = f.lane AND o.k = f.k + 1
)
SELECT g.doc_id, CAST(f.chunk AS INTEGER) AS chunk_id FROM g JOIN f ON f.lane = g.lane AND f.unit = g.unit
"""
)
def atomic_chunks(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("g"), F.col("doc_id") % 97)).alias("grp"))
    return chunk.atomic_chunks(df, "doc_id", "grp", 25, F.col("lang")).select("doc_id", "chunk_id")


@query("SELECT o_custkey, o_orderkey, last_value(v IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS v FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS v FROM orders) x")
def forward_fill(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("v"))
    return chunk.forward_fill(df, ["o_custkey"], ["o_orderkey"], ["v"])


@query(
    """
WITH c AS (SELECT event_id, user_id, event_type, CASE WHEN event_type = lag(event_type) OVER w OR lag(event_id) OVER w IS NULL THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (ORDER BY user_id, event_id)),
r AS (SELECT *, sum(c) OVER (ORDER BY user_id, event_id) AS run FROM c)
SELECT event_id, CAST(run AS BIGINT) AS run, CAST(floor((row_number() OVER (PARTITION BY run ORDER BY user_id, event_id) - 1) / 2) AS BIGINT) AS batch_in_run FROM r
"""
)
def run_batches_global(spark, sf):
    out = chunk.run_batches(table(spark, sf, "events").select("user_id", "event_id", "event_type"), [], ["user_id", "event_id"], "event_type", 2)
    return out.select("event_id", "run", "batch_in_run")


@query("SELECT o_orderkey, last_value(v IGNORE NULLS) OVER (ORDER BY o_orderkey) AS v, last_value(d IGNORE NULLS) OVER (ORDER BY o_orderkey) AS d FROM (SELECT o_orderkey, CASE WHEN o_custkey % 50 = 7 THEN o_orderpriority END AS v, CASE WHEN o_custkey % 400 = 9 THEN o_orderdate END AS d FROM orders) x")
def forward_fill_global(spark, sf):
    value = lambda n, k, c: F.when(F.col("o_custkey") % n == k, F.col(c))
    df = table(spark, sf, "orders").select("o_orderkey", value(50, 7, "o_orderpriority").alias("v"), value(400, 9, "o_orderdate").alias("d"))
    return chunk.forward_fill(df, [], ["o_orderkey"], ["v", "d"])


@query(
    """
WITH RECURSIVE g AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'r' || doc_id ELSE 'g' || (doc_id % 97) || coalesce(lang, '') END AS unit FROM documents),
o AS (SELECT unit, count(*) AS n, row_number() OVER (ORDER BY min(doc_id), unit) AS k FROM g GROUP BY unit),
f AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS chunk, CAST(0 AS BIGINT) AS n_rows
  UNION ALL
  SELECT o.k, f.chunk + CASE WHEN f.n_rows = 0 OR f.n_rows + o.n > 25 THEN 1 ELSE 0 END,
    CASE WHEN f.n_rows = 0 OR f.n_rows + o.n > 25 THEN CASE WHEN o.n >= 25 THEN 0 ELSE o.n END WHEN f.n_rows + o.n = 25 THEN 0 ELSE f.n_rows + o.n END
  FROM f JOIN o ON o.k = f.k + 1
)
SELECT g.doc_id, CAST(f.chunk AS INTEGER) AS chunk_id FROM g JOIN o USING (unit) JOIN f ON f.k = o.k
"""
)
def atomic_chunks_global(spark, sf):
    group = F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("g"), F.col("doc_id") % 97, F.coalesce("lang", F.lit(""))))
    df = table(spark, sf, "documents").select("doc_id", group.alias("grp"))
    return chunk.atomic_chunks(df, "doc_id", "grp", 25).select("doc_id", "chunk_id")


# ---- resolution

_GRAPH = """
WITH RECURSIVE n AS (SELECT s_suppkey AS id, s_suppkey % 40 AS a, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey % 7 END AS b FROM supplier WHERE s_suppkey % 2 = 1),
e AS (SELECT x.id AS u, y.id AS v FROM n x JOIN n y ON x.a = y.a OR x.b = y.b),
r AS (SELECT id AS u, id AS v FROM n UNION SELECT r.u, e.v FROM r JOIN e ON e.u = r.v),
c AS (SELECT u AS id, min(v) AS component FROM r GROUP BY u),
g AS (SELECT component, count(*) AS n, string_agg(CAST(id AS VARCHAR), ';' ORDER BY id) AS members, dense_rank() OVER (ORDER BY component) AS k,
  count(DISTINCT a) = 1 AS by_name, count(b) = count(*) AND count(DISTINCT b) = 1 AS by_url FROM c JOIN n USING (id) GROUP BY component HAVING count(*) > 1)
"""


@query(_GRAPH + "SELECT c.id, 'dup_' || lpad(CAST(g.k AS VARCHAR), 4, '0') AS \"group\", g.members, g.n AS candidate_count, CASE WHEN by_name AND by_url THEN 'name;url' WHEN by_name THEN 'name' WHEN by_url THEN 'url' ELSE 'transitive' END AS match_basis FROM c JOIN g USING (component)")
def duplicate_components(spark, sf):
    k = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(
        k.alias("id"),
        F.concat(F.lit("Atlas "), k % 40, F.lit(" database")).alias("database_name"),
        F.when(k % 3 == 0, F.concat(F.lit("http://www.example.org/"), k % 7, F.lit("/#x"))).otherwise(F.lit("none")).alias("database_url"),
        F.when(k % 2 == 1, F.lit("YES")).otherwise(F.lit("no")).alias("db_type_confirmation"),
    )
    return resolve.catalog_duplicates(rows, None).select("id", "group", "members", "candidate_count", "match_basis")


@query(
    """
WITH m AS (SELECT text, min(doc_id) AS rep, count(*) AS n, bool_or(doc_id % 4 = 0) AS any_yes FROM documents GROUP BY text)
SELECT d.doc_id, CASE WHEN n > 1 AND any_yes THEN 'yes' WHEN d.doc_id % 4 = 0 THEN 'yes' ELSE 'no' END AS original48, FALSE AS removed, CAST(NULL AS BIGINT) AS representative FROM documents d JOIN m ON m.text = d.text AND m.rep = d.doc_id
UNION ALL SELECT d.doc_id, NULL, TRUE, m.rep FROM documents d JOIN m ON m.text = d.text AND m.rep <> d.doc_id
"""
)
def apply_merge_decisions(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 4 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("original48"))
    reps = docs.groupBy("text").agg(F.min("doc_id").alias("representative"))
    decisions = docs.join(reps, "text").filter("doc_id <> representative").select(F.col("doc_id").alias("id"), "representative")
    kept, removed = resolve.apply_merges(docs.drop("text"), decisions, "doc_id", "original48")
    return kept.select("doc_id", "original48", F.lit(False).alias("removed"), F.lit(None).cast("bigint").alias("representative")).union(removed.select("doc_id", F.lit(None).cast("string"), F.lit(True), "representative"))


# ---- parsers


@query(
    r"""
WITH a AS (SELECT event_id, event_id % 5 AS k, json_extract_string(props, '$.k') AS n FROM events)
SELECT event_id, CASE k WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Yes' ELSE 'No' END AS ai_check,
  CASE k WHEN 0 THEN 'n=' || n WHEN 1 THEN 'wrapped ' || n WHEN 2 THEN 'Model returned non-JSON output; parsed answer from text.'
  WHEN 3 THEN 'Model returned invalid output; defaulted to No.' ELSE 'Model returned non-JSON output; parsed answer from text.' END AS ai_reason FROM a
"""
)
def parse_ai_json(spark, sf):
    k, n = F.col("event_id") % 5, F.get_json_object("props", "$.k")
    raw = (
        F.when(k == 0, F.concat(F.lit('```json\n{"AI_check": "YES.", "AI_reason": " n='), n, F.lit('"}\n```')))
        .when(k == 1, F.concat(F.lit('Here: {"AI_check": "no", "AI_reason": "wrapped '), n, F.lit('"} done')))
        .when(k == 2, F.lit("Yes"))
        .when(k == 3, F.lit("not json"))
        .otherwise(F.lit('{"AI_check": "no", "AI_reason": ""}'))
    )
    p = model_output.parse_check(raw)
    return table(spark, sf, "events").select("event_id", p["AI_check"].alias("ai_check"), p["AI_reason"].alias("ai_reason"))


@query(
    """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Reject' WHEN 1 THEN 'Pass' ELSE 'Unclear' END AS decision,
  CASE WHEN event_id % 4 IN (0, 1) THEN 'v ' || json_extract_string(props, '$.k') WHEN event_id % 4 = 2 THEN 'v ' || json_extract_string(props, '$.k') ELSE 'Model returned invalid output; routed to expert model.' END AS reason FROM events
"""
)
def parse_stage1(spark, sf):
    k, n = F.col("event_id") % 4, F.get_json_object("props", "$.k")
    word = F.when(k == 0, F.lit("Rejected")).when(k == 1, F.lit("PASS!")).otherwise(F.lit("maybe"))
    raw = F.when(k == 3, F.lit('[{"stage1_decision": "Pass"}]')).otherwise(F.concat(F.lit('{"stage1_decision": "'), word, F.lit('", "stage1_reason": "v '), n, F.lit('"}')))
    p = model_output.parse_triage(raw)
    return table(spark, sf, "events").select("event_id", p["stage1_decision"].alias("decision"), p["stage1_reason"].alias("reason"))


@query(
    """
WITH a AS (SELECT event_id, event_id % 10 AS k, event_id % 9 AS c FROM events)
SELECT event_id, CASE WHEN k = 9 OR c NOT BETWEEN 1 AND 7 THEN NULL ELSE c END AS ai_class, CASE WHEN k = 9 OR c NOT BETWEEN 1 AND 7 THEN NULL WHEN c <= 5 THEN 'Yes' ELSE 'No' END AS ai_check,
  CASE WHEN k = 9 OR c NOT BETWEEN 1 AND 7 THEN NULL WHEN k % 2 = 0 THEN 'atlas' WHEN c IN (6, 7) THEN 'none' ELSE 'other' END AS resource_type,
  CASE WHEN k = 9 OR c NOT BETWEEN 1 AND 7 THEN NULL ELSE ['direct_splicing', 'transcript_model', 'transcript_level_abundance', 'needs_web_verification', 'needs_web_verification', 'none', 'none'][CAST(c AS INTEGER)] END AS scope,
  CASE WHEN k = 9 THEN 'Model returned no JSON object' WHEN c NOT BETWEEN 1 AND 7 THEN 'Stage2 response has invalid AI_class: ' || c END AS error FROM a
"""
)
def parse_stage2(spark, sf):
    k, c = F.col("event_id") % 10, F.col("event_id") % 9
    kind = F.when(k % 2 == 0, F.lit("atlas")).otherwise(F.lit("thing"))
    raw = F.when(k == 9, F.lit("none of it")).otherwise(F.concat(F.lit('{"AI_class": "'), c, F.lit('", "AI_check": "No", "resource_type": "'), kind, F.lit('", "target_scope_hint": "none"}')))
    p = model_output.parse_classification(raw, "v1")
    return table(spark, sf, "events").select("event_id", p["AI_class"].cast("bigint").alias("ai_class"), p["AI_check"].alias("ai_check"), p["resource_type"].alias("resource_type"), p["target_scope_hint"].alias("scope"), p["error"].alias("error"))


@query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '12' WHEN 1 THEN 'A-7' WHEN 2 THEN '-3' WHEN 3 THEN '' ELSE '4.5' END AS id, CASE c_custkey % 5 WHEN 0 THEN 12 WHEN 2 THEN -3 WHEN 4 THEN 4 ELSE 0 END AS n FROM customer")
def clean_identifiers(spark, sf):
    k = F.col("c_custkey") % 5
    raw = F.when(k == 0, F.lit(" 12.00\t")).when(k == 1, F.lit("A-7 ")).when(k == 2, F.lit("-3.0")).when(k == 4, F.lit("4.5"))
    return table(spark, sf, "customer").select("c_custkey", X.clean_id(raw).alias("id"), X.to_int(raw).cast("int").alias("n"))
