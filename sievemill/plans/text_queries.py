"""Queries of screening, deduplication, pools, addresses, identifiers and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.functions import ids, tags, urls
from sievemill.functions import text as X
from sievemill.operators import dedup, link, resolve, screen

from .registry import query, table

# lexicons that fit the tables
RESOURCE, SCOPE = r"\b(?:licen[sc]es?|mit)\b", r"\b(?:the|der|les|de)\b"

# In the SQL below words are runs of letters, digits and underscores: DuckDB's \b and \w know ASCII only.
_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
_TERMS = "list_sort(list_distinct(list_filter(" + _WORDS + ", lambda w: regexp_full_match(w, '{1}'))))"


def _joined(c: str):
    return F.array_join(c, ";").alias(c)


def _papers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("pos"), F.lit("").alias("title"), F.col("text").alias("abstractText"), "source", "lang", "n_chars")


def _screen_sql(scope: bool) -> str:
    a, b = _TERMS.format("text", "licen[sc]es?|mit"), _TERMS.format("text", "the|der|les|de")
    second = f"array_to_string({b}, ';')" if scope else "''"
    return f"SELECT doc_id, array_to_string({a}, ';') AS matched_terms, {second} AS matched_scope_terms FROM documents WHERE len({a}) > 0" + (f" AND len({b}) > 0" if scope else "")


@query(_screen_sql(True))
def keyword_screen(spark, sf):
    out = screen.keyword_screen(_papers(spark, sf), RESOURCE, SCOPE)
    return out.select(F.col("pos").alias("doc_id"), _joined("matched_terms"), _joined("matched_scope_terms"))


@query(_screen_sql(False))
def keyword_screen_no_scope(spark, sf):
    out = screen.keyword_screen(_papers(spark, sf), RESOURCE, None)
    return out.select(F.col("pos").alias("doc_id"), _joined("matched_terms"), _joined("matched_scope_terms"))


@query(
    f"""
WITH pool AS (
  SELECT text, source, 0 AS side, doc_id AS pos FROM documents
  UNION ALL SELECT text, 'conversation', 1, conv_id * 1000 + turn FROM conversations
  UNION ALL SELECT text, 'benchmark', 2, item_id FROM benchmark
), firsts AS (
  SELECT text, source FROM (
    SELECT *, row_number() OVER (PARTITION BY lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) ORDER BY side, pos, source) AS k FROM pool) x WHERE k = 1
)
SELECT source, count(*) AS n_candidates, CAST(count_if(len({_TERMS.format("text", "licen[sc]es?|mit")}) > 0 AND len({_TERMS.format("text", "the|der|les|de")}) > 0) AS BIGINT) AS n_screened
FROM firsts GROUP BY source
"""
)
def candidate_funnel(spark, sf):
    docs, talks, bench = (table(spark, sf, t) for t in ("documents", "conversations", "benchmark"))
    pool = (
        docs.select("text", "source", F.lit(0).alias("side"), F.col("doc_id").alias("pos"))
        .union(talks.select("text", F.lit("conversation"), F.lit(1), F.col("conv_id") * 1000 + F.col("turn")))
        .union(bench.select("text", F.lit("benchmark"), F.lit(2), F.col("item_id")))
    )
    firsts = dedup.keep_first(pool, X.title_key(F.col("text")), [], ["side", "pos", "source"])
    passes = (F.size(screen.matched_terms(F.col("text"), RESOURCE)) > 0) & (F.size(screen.matched_terms(F.col("text"), SCOPE)) > 0)
    return firsts.groupBy("source").agg(F.count("*").alias("n_candidates"), F.count_if(passes).alias("n_screened"))


@query("SELECT n_chars < 20 AS is_missing, count(*) AS n FROM documents GROUP BY 1")
def split_missing_text(spark, sf):
    blanked = _papers(spark, sf).withColumn("abstractText", F.when(F.col("n_chars") < 20, F.lit(" \t")).otherwise(F.col("abstractText")))
    has, lacks = screen.split_missing(blanked)
    counts = has.agg(F.count("*").alias("n")).select(F.lit(False).alias("is_missing"), "n").union(lacks.agg(F.count("*").alias("n")).select(F.lit(True), "n"))
    return counts.filter("n > 0")


_SEEDS = "SELECT doc_id, cited FROM (SELECT doc_id, n_chars AS cited, row_number() OVER (PARTITION BY lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) ORDER BY {0}) AS k FROM documents) x WHERE k = 1"


def _seeds(spark, sf, order):
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("pos"), F.col("text").alias("title"), F.col("n_chars").alias("citedByCount"))
    return dedup.seed_articles(rows, order, "pos").select(F.col("pos").alias("doc_id"), F.col("citedByCount").alias("cited"))


@query(_SEEDS.format("n_chars DESC, doc_id"))
def seed_dedupe_citations(spark, sf):
    return _seeds(spark, sf, "citations")


@query(_SEEDS.format("doc_id"))
def seed_dedupe_relevance(spark, sf):
    return _seeds(spark, sf, "relevance")


_DETAIL_KEY = """CASE WHEN o_orderkey % 3 = 0 THEN 'doi:10.1234/' || (o_custkey % 50) WHEN o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 THEN 'pmid:' || (o_custkey % 70)
 WHEN o_orderkey % 5 = 0 THEN 'pmcid:pmc' || (o_custkey % 30) WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'title:' || lower(o_orderpriority) END"""


@query(
    f"""
WITH k AS (SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS cited, {_DETAIL_KEY} AS key FROM orders)
SELECT o_orderkey, cited FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY cited DESC, o_orderkey) AS r FROM k WHERE key IS NOT NULL) x WHERE r = 1
UNION ALL SELECT o_orderkey, cited FROM k WHERE key IS NULL
"""
)
def detail_dedupe_priority(spark, sf):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    blank = F.lit("  ")
    rows = table(spark, sf, "orders").select(
        key.alias("pos"),
        F.col("o_totalprice").alias("citedByCount"),
        F.when(key % 3 == 0, F.concat(F.lit("10.1234/"), cust % 50)).otherwise(blank).alias("doi"),
        F.when((key % 3 == 1) & (key % 2 == 0), (cust % 70).cast("string")).otherwise(blank).alias("pmid"),
        F.when(key % 5 == 0, F.concat(F.lit("PMC"), cust % 30)).alias("pmcid"),
        F.when(key % 7 != 0, F.col("o_orderpriority")).otherwise(blank).alias("title"),
    )
    return dedup.reference_details(rows, "pos").select(F.col("pos").alias("o_orderkey"), X.to_int(F.col("citedByCount")).alias("cited"))


_POOL_ID = "lower(trim(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')))"


@query(
    f"""
WITH b AS (SELECT text, 'citation' AS candidate_source, 0 AS side, doc_id AS pos FROM documents UNION ALL SELECT text, 'seed', 1, item_id FROM benchmark),
x AS (SELECT *, row_number() OVER (PARTITION BY {_POOL_ID} ORDER BY side, pos) AS k FROM b)
SELECT candidate_source, pos FROM x WHERE k = 1
"""
)
def candidate_pool(spark, sf):
    side = lambda df, key: df.select(F.col("text").alias("title"), F.col(key).alias("pos"), F.lit("").alias("doi"), F.lit("").alias("pmid"), F.lit("").alias("pmcid"))
    out = dedup.candidate_pool(side(table(spark, sf, "benchmark"), "item_id"), side(table(spark, sf, "documents"), "doc_id"), "pos")
    return out.select("candidate_source", "pos")


@query(
    f"""
WITH f AS (SELECT item_id % 7 AS item, text FROM benchmark UNION ALL SELECT item_id + 100000, text FROM benchmark),
g AS (SELECT item, text, row_number() OVER (PARTITION BY {_POOL_ID} ORDER BY item) AS k FROM f)
SELECT 'base' AS origin, doc_id AS pos FROM documents
UNION ALL SELECT 'forced', item FROM g WHERE k = 1 AND {_POOL_ID} NOT IN (SELECT {_POOL_ID} FROM documents)
"""
)
def forced_include(spark, sf):
    base = table(spark, sf, "documents").select(F.lit("base").alias("origin"), F.col("doc_id").alias("pos"), F.col("text").alias("title"))
    bench = table(spark, sf, "benchmark")
    forced = bench.select((F.col("item_id") % 7).alias("pos"), F.col("text").alias("title")).union(bench.select(F.col("item_id") + 100000, "text"))
    out = dedup.forced_includes(base, forced.select(F.lit("forced").alias("origin"), "pos", "title"), "pos")
    return out.select("origin", "pos")


@query("SELECT text AS text, doc_id, first_seen FROM (SELECT lower(text) AS text, doc_id, min(doc_id) OVER (PARTITION BY text) AS first_seen FROM documents) x WHERE doc_id > first_seen")
def duplicate_id_first_seen(spark, sf):
    out = dedup.duplicate_ids(table(spark, sf, "documents").select("doc_id", "text"), "text", "doc_id")
    return out.select(F.lower("text").alias("text"), "doc_id", "first_seen")


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_pending(spark, sf):
    return link.pending(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"])


# ---- addresses

_REST = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_HOST = "regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), ':[0-9]*$', ''), '^www\\.', '')"
_QUERY = "CASE WHEN regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) <> '' THEN '?' || regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) ELSE '' END"
_KEY = f"'//' || {_HOST} || CASE WHEN {_REST} IN ('', '/') THEN '/' ELSE rtrim({_REST}, '/') END || {_QUERY}"


@query(f"SELECT page_id, {_KEY} AS url_key FROM pages")
def url_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.url_key(F.col("url")).alias("url_key"))


@query(f"SELECT page_id, regexp_replace({_KEY}, '([^/])/+', '\\1/', 'g') AS url_key FROM pages")
def db_url_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.database_url_key(F.col("url")).alias("url_key"))


@query(f"SELECT {_HOST} AS host, count(*) AS n FROM pages GROUP BY 1")
def url_host(spark, sf):
    return table(spark, sf, "pages").groupBy(urls.host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


@query(
    """
WITH p AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS u FROM pages),
q AS (SELECT page_id, lower(regexp_extract(u, '^([a-zA-Z]+)://', 1)) AS s, regexp_extract(u, '^[a-zA-Z]+://([^/?]*)', 1) AS h, regexp_replace(u, '^[a-zA-Z]+://[^/?]*', '') AS r FROM p),
v AS (SELECT page_id, s, r, CASE WHEN s = 'https' THEN 'http' ELSE 'https' END AS o, h, CASE WHEN starts_with(lower(h), 'www.') THEN h[5:] ELSE 'www.' || h END AS t FROM q)
SELECT page_id, unnest([1, 2, 3, 4]) AS place, unnest([s || '://' || h || r, s || '://' || t || r, o || '://' || h || r, o || '://' || t || r]) AS url FROM v
"""
)
def url_candidates(spark, sf):
    out = table(spark, sf, "pages").select("page_id", F.posexplode(urls.url_candidates(F.col("url"))).alias("p", "url"))
    return out.select("page_id", (F.col("p") + 1).alias("place"), "url")


@query(
    f"""
WITH k AS (SELECT page_id, url, {_KEY} AS url_key FROM pages), g AS (SELECT url_key, arg_min(url, page_id) AS checked, count(*) AS n FROM k GROUP BY 1)
SELECT k.page_id, k.url, g.checked, length(g.checked) AS checked_length FROM k JOIN g USING (url_key)
"""
)
def url_dedup_fanout(spark, sf):
    check = lambda firsts: firsts.select("url_key", F.col("url").alias("checked"), F.length("url").cast("bigint").alias("checked_length"))
    return link.fan_out(table(spark, sf, "pages").select("page_id", "url"), "url", "page_id", check).select("page_id", "url", "checked", "checked_length")


@query(
    r"""
WITH f AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?i)\b(?:https?://|www\.)[^\s<>"]+'), lambda u:
    CASE WHEN starts_with(lower(rtrim(u, '.,;:)]}>"''')), 'www.') THEN 'https://' || rtrim(u, '.,;:)]}>"''') ELSE rtrim(u, '.,;:)]}>"''') END),
    lambda u: u <> '' AND NOT (contains(lower(u), 'doi.org/') OR contains(lower(u), 'europepmc.org/') OR contains(lower(u), 'pubmed.ncbi.nlm.nih.gov/') OR contains(lower(u), 'ncbi.nlm.nih.gov/pubmed'))) AS us FROM pages)
SELECT page_id, coalesce(us[1], '') AS url FROM f
"""
)
def extract_first_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.first_database_url(F.col("html")).alias("url"))


@query(
    r"""
WITH p AS (SELECT page_id, [200, 200, 403, 404, 429, 500, 301][CAST(page_id % 7 AS INTEGER) + 1] AS code,
  CASE WHEN page_id % 11 = 0 THEN html || '<a> Continue to site </a>' WHEN page_id % 13 = 0 THEN html || 'Verify you are human' WHEN page_id % 17 = 0 THEN html || 'Buy this domain' ELSE html END AS body FROM pages)
SELECT page_id, CASE WHEN code IN (401, 403, 429) THEN 'restricted'
  WHEN regexp_matches(body, '(?i)>\s*(?:continue(?:\s+(?:anyway|to(?:\s+the)?\s+site))?|proceed(?:\s+anyway)?|enter(?:\s+the)?\s+site|i\s+understand)\s*<') THEN 'continue_required'
  WHEN regexp_matches(body, '(?i)captcha|verify\s+(?:that\s+)?you\s+are\s+(?:a\s+)?human|checking\s+your\s+browser|buy\s+(?:this|the)\s+domain|domain\s+(?:name\s+)?(?:is\s+)?(?:for\s+sale|parked)') THEN 'restricted'
  WHEN code < 400 THEN 'reachable' ELSE 'unreachable' END AS status FROM p
"""
)
def page_status(spark, sf):
    k = F.col("page_id")
    code = F.element_at(F.array(*[F.lit(x) for x in (200, 200, 403, 404, 429, 500, 301)]), (k % 7 + 1).cast("int"))
    extra = F.when(k % 11 == 0, F.lit("<a> Continue to site </a>")).when(k % 13 == 0, F.lit("Verify you are human")).when(k % 17 == 0, F.lit("Buy this domain")).otherwise(F.lit(""))
    return table(spark, sf, "pages").select("page_id", urls.page_status(code, F.concat("html", extra)).alias("status"))


# ---- identifiers

_DOI = """CASE o_orderkey % 6 WHEN 0 THEN 'https://doi.org/10.1000/AbC.' || o_custkey || '.' WHEN 1 THEN 'DOI: 10.1000/AbC.' || o_custkey WHEN 2 THEN 'http://dx.doi.org/10.1000/X' || o_custkey
 WHEN 3 THEN '  n/a ' WHEN 4 THEN 'doi:https://doi.org/10.1000/Q' || o_custkey ELSE '10.1000/Plain' || o_custkey END"""


@query(
    f"""
WITH d AS (SELECT o_orderkey, trim({_DOI}) AS d FROM orders)
SELECT o_orderkey,
  CASE WHEN lower(d) = 'n/a' THEN '' ELSE trim(regexp_replace(regexp_replace(d, '(?i)^doi:\\s*', ''), '(?i)^https?://(dx\\.)?doi\\.org/', '')) END AS token,
  trim(regexp_replace(regexp_replace(lower(d), '^https?://(dx\\.)?doi\\.org/', ''), '^doi:\\s*', '')) AS matching,
  CASE WHEN lower(d) = 'n/a' THEN '' ELSE lower(rtrim(trim(regexp_replace(regexp_replace(d, '(?i)^https?://(dx\\.)?doi\\.org/', ''), '(?i)^doi:\\s*', '')), '.')) END AS identity,
  regexp_replace(d, '(?i)^https?://doi\\.org/', '') AS bare, lower(d) AS dedup,
  CASE WHEN regexp_replace(d, '^https?://(dx\\.)?doi\\.org/', '') <> '' THEN 'https://doi.org/' || regexp_replace(d, '^https?://(dx\\.)?doi\\.org/', '') ELSE '' END AS web
FROM d
"""
)
def doi_normalizers(spark, sf):
    k, c = F.col("o_orderkey") % 6, F.col("o_custkey").cast("string")
    doi = (
        F.when(k == 0, F.concat(F.lit("https://doi.org/10.1000/AbC."), c, F.lit(".")))
        .when(k == 1, F.concat(F.lit("DOI: 10.1000/AbC."), c))
        .when(k == 2, F.concat(F.lit("http://dx.doi.org/10.1000/X"), c))
        .when(k == 3, F.lit("  n/a "))
        .when(k == 4, F.concat(F.lit("doi:https://doi.org/10.1000/Q"), c))
        .otherwise(F.concat(F.lit("10.1000/Plain"), c))
    )
    forms = {"token": ids.doi_token, "matching": ids.doi_matching, "identity": ids.doi_identity, "bare": ids.doi_bare, "dedup": ids.doi_key}
    return table(spark, sf, "orders").select("o_orderkey", *[f(doi).alias(n) for n, f in forms.items()], ids.web_from_doi(doi)[1].alias("web"))


def _customer_ids(spark, sf):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(k % 4 == 0, F.concat(F.lit("https://doi.org/10.5/"), n, F.lit("."))).otherwise(F.lit("N/A")).alias("doi"),
        F.when(k % 4 == 1, F.concat(n.cast("string"), F.lit(".0"))).alias("pmid"),
        F.when(k % 4 == 2, F.concat(F.lit(" PMC"), n)).otherwise(F.lit("-")).alias("pmcid"),
        F.when(k % 8 == 3, F.concat(F.lit(" The  "), F.col("c_mktsegment"))).alias("title"),
    )


@query(
    """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'doi:10.5/' || c_nationkey WHEN 1 THEN 'pmid:' || c_nationkey WHEN 2 THEN 'pmcid:pmc' || c_nationkey
  ELSE CASE WHEN c_custkey % 8 = 3 THEN 'title:the ' || lower(c_mktsegment) ELSE '' END END AS identity_key FROM customer
"""
)
def identity_key(spark, sf):
    return _customer_ids(spark, sf).select("c_custkey", ids.identity_key(F.col("doi"), F.col("pmid"), F.col("pmcid"), F.col("title")).alias("identity_key"))


@query(
    """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'doi:https://doi.org/10.5/' || c_nationkey || '.' ELSE 'doi:n/a' END AS paper_key FROM customer
"""
)
def paper_key(spark, sf):
    return _customer_ids(spark, sf).select("c_custkey", ids.paper_key(F.col("c_custkey"), F.col("doi"), F.col("pmid"), F.col("pmcid"), F.col("title")).alias("paper_key"))


@query(
    r"""
WITH n AS (SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN 'ABC' || (s_suppkey % 9) || ': ' || s_name || ' database' WHEN 1 THEN s_name || ' (Alias' || (s_suppkey % 5) || ') DB'
  WHEN 2 THEN 'Atlas & ' || s_name || ' v 2.1' ELSE 'unknown' END AS name FROM supplier),
k AS (SELECT id, name, regexp_replace(regexp_replace(trim(regexp_replace(replace(lower(name), '&', ' and '), '(?:\b(?:database|db)\b\s*)+$', '')), '\b(?:version|release|v)\s*[0-9]+(?:\.[0-9]+)*\b', '', 'g'), '[^a-z0-9]+', '', 'g') AS whole,
  lower(regexp_extract(name, '\(([A-Za-z][A-Za-z0-9_-]{1,15})\)', 1)) AS alias, lower(regexp_extract(name, '^([A-Z][A-Z0-9_-]{1,14})\s*[:-]', 1)) AS lead FROM n)
SELECT id, array_to_string(list_sort(list_filter([CASE WHEN name = 'unknown' THEN '' ELSE whole END, alias, lead], lambda x: x <> '')), ';') AS keys FROM k
"""
)
def name_keys(spark, sf):
    k = F.col("s_suppkey")
    name = (
        F.when(k % 4 == 0, F.concat(F.lit("ABC"), k % 9, F.lit(": "), F.col("s_name"), F.lit(" database")))
        .when(k % 4 == 1, F.concat(F.col("s_name"), F.lit(" (Alias"), k % 5, F.lit(") DB")))
        .when(k % 4 == 2, F.concat(F.lit("Atlas & "), F.col("s_name"), F.lit(" v 2.1")))
        .otherwise(F.lit("unknown"))
    )
    return table(spark, sf, "supplier").select(k.alias("id"), F.array_join(F.array_sort(resolve.name_keys(name)), ";").alias("keys"))


# ---- tags


def _part_tags(spark, sf):
    cell = F.concat_ws("; ", F.split("p_name", " "))
    return table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice", F.concat(cell, F.lit(";"), F.upper(F.element_at(F.split("p_name", " "), 1)), F.lit(";; ")).alias("cell"))


_CELL = "list_transform(string_split(p_name, ' '), lambda x: trim(x))"


@query(
    f"""
WITH t AS (SELECT p_partkey, list_filter({_CELL}, lambda x: x <> '') AS w FROM part),
u AS (SELECT p_partkey, list_filter(w, lambda x, i: list_position(list_transform(w, lambda y: lower(y)), lower(x)) = i) AS w FROM t)
SELECT p_partkey, array_to_string(w, ';') AS tags, CAST(len(w) AS INTEGER) AS n FROM u
"""
)
def tag_normalize(spark, sf):
    cell = tags.normalize_tags(F.col("cell"))
    return _part_tags(spark, sf).select("p_partkey", cell.alias("tags"), F.size(F.split(cell, ";")).alias("n"))


@query(
    """
WITH t AS (SELECT DISTINCT unnest(list_filter(string_split(p_name, ' '), lambda x: x <> '')) AS tag FROM part), u AS (SELECT DISTINCT p_type AS tag FROM part),
r AS (SELECT 'cell' AS column_name, tag, row_number() OVER (ORDER BY lower(tag), tag) AS position, count(*) OVER () AS n FROM t
      UNION ALL SELECT 'p_type', tag, row_number() OVER (ORDER BY lower(tag), tag), count(*) OVER () FROM u)
SELECT column_name, tag, CAST(position AS INTEGER) AS position, position <= 50 AS preview, CAST(greatest(n - 50, 0) AS INTEGER) AS n_more FROM r
"""
)
def tag_facets(spark, sf):
    from sievemill.operators.search import facets

    df = table(spark, sf, "part").select(F.array_join(F.split("p_name", " "), ";").alias("cell"), "p_type")
    return facets(df, ["cell", "p_type"])
