import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sievemill.functions import urls
from sievemill.operators import catalog, chunk, dedup, link, resolve, screen, search, stats, summary, validate
from sievemill.operators.components import connected_components


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows_of(df, *cols):
    return [tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()]


# ---- screening


def test_keyword_screen(spark):
    df = frame(spark, "title string, abstractText string", ("An atlas", "of splicing; a Portal"), ("atlas", "birds"), (None, "RNA-seq"), ("Database", None))
    out = screen.keyword_screen(df).collect()
    assert len(out) == 1 and out[0].matched_terms == ["atlas", "portal"] and out[0].matched_scope_terms == ["splicing"]
    assert screen.keyword_screen(df, scope=None).count() == 3


def test_the_first_alternative_wins(spark):
    df = frame(spark, "t string", ("RNA-seq of poly(A) tails, café",))
    assert df.select(screen.matched_terms(F.col("t"), screen.SCOPE_PATTERN)).first()[0][0] == "poly(a"
    assert "rna" in df.select(screen.matched_terms(F.col("t"), screen.SCOPE_PATTERN)).first()[0]
    assert df.select(screen.matched_terms(F.col("t"), r"\bcaf\w*\b")).first()[0] == ["café"]


def test_split_missing(spark):
    df = frame(spark, "title string, abstractText string", ("a", "x"), ("b", ""), ("c", None))
    has, lacks = screen.split_missing(df)
    assert has.count() == 1 and lacks.count() == 2 and screen.split_missing(df, "gone")[1].count() == 3
    assert screen.yes_only(frame(spark, "AI_check string", (" YES",), ("no",), (None,))).count() == 1 and screen.yes_only(df).count() == 0


# ---- deduplication


def test_seed_articles(spark):
    df = frame(spark, "pos int, title string, citedByCount string", (0, "A Title ", "12"), (1, "a title", "99"), (2, "", "1"), (3, " ", "2"), (4, "b", "x"))
    assert rows_of(dedup.seed_articles(df, "citations", "pos"), "pos") == [1, 3, 4]
    assert rows_of(dedup.seed_articles(df, "relevance", "pos", 2), "pos") == [0, 2]
    with pytest.raises(ValueError):
        dedup.seed_articles(df, "other", "pos")


def test_reference_details(spark):
    cols = "pos int, title string, doi string, pmid string, pmcid string, citedByCount string"
    df = frame(spark, cols, (0, "A", "10.1/x", "", "", "1"), (1, "A better", "10.1/X", "5", "", "9"), (2, "Same title", "", "", "", "3"), (3, "same TITLE", "", "", None, "2"), (4, "", "", "", "", "0"), (5, None, None, None, None, None))
    assert rows_of(dedup.reference_details(df, "pos"), "pos") == [1, 2, 4, 5]


def test_candidate_pool(spark):
    cols = "pos int, title string, abstractText string, doi string, pmid string, pmcid string"
    detail = frame(spark, cols, (0, "cited", "x", "10.1/a", "", ""), (1, "", "", "", "", ""), (2, "", "", "", "", ""))
    seed = frame(spark, cols, (0, "seed", "y", "https://doi.org/10.1/A", "", ""), (1, "new", "", "", "7", ""))
    out = dedup.candidate_pool(seed, detail, "pos")
    assert sorted(rows_of(out, "candidate_source", "pos")) == [("citation", 0), ("citation", 1), ("citation", 2), ("seed", 1)]


def test_forced_includes(spark):
    base = frame(spark, "pos int, title string, doi string, resource_name string", (0, "t", "10.1/a", ""), (1, "u", "", ""))
    forced = frame(spark, "pos int, title string, doi string, resource_name string, force_reason string", (0, "z", "doi:10.1/A", "", "r"), (1, "", "", "New DB", "r"), (2, "", "", "new db", "r"), (3, "", "", "", "r"))
    out = dedup.forced_includes(base, forced, "pos")
    assert sorted(rows_of(out.filter("force_reason = 'r'"), "pos")) == [1, 3] and out.count() == 4


def test_targets(spark):
    edges = frame(spark, "pos int, ref_source string, ref_id string", (0, "MED", "1 "), (1, "MED", "1"), (2, "", "3"), (3, "PMC", "2"))
    assert rows_of(dedup.reference_targets(edges, "pos"), "ref_source", "ref_id") == [("MED", "1"), ("PMC", "2")]
    assert rows_of(dedup.seed_pmids(frame(spark, "pos int, pmid string", (0, "PMID 12"), (1, "12.0"), (2, None), (3, "7")), "pos"), "pmid") == ["12", "7"]


def test_dedup_is_idempotent_and_partition_free(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(i, f"t{rnd.randrange(30)}", str(rnd.randrange(5))) for i in range(300)], "pos int, title string, citedByCount string")
    once = dedup.seed_articles(df, "citations", "pos")
    assert once.collect() == dedup.seed_articles(df.repartition(7), "citations", "pos").collect() == dedup.seed_articles(once, "citations", "pos").collect()


# ---- lookups


def test_benchmark_first(spark):
    df = frame(spark, "pos int, title string, doi string, pmid string", (0, "other", "", "9"), (1, "x", "https://doi.org/10.1/A", ""), (2, "A  title.", "", "123.0"))
    bench = frame(spark, "title string, doi string, pmid string", ("a title", "", ""), ("", "doi:10.1/a", ""), ("", "", "5"))
    assert rows_of(link.benchmark_first(df, bench, "pos"), "pos", "is_benchmark") == [(1, True), (2, True), (0, False)]


def test_fan_out(spark):
    df = frame(spark, "pos int, url string", (0, "https://example.org/db/"), (1, "http://www.example.org/db"), (2, None))
    seen = []
    out = link.fan_out(df, "url", "pos", lambda f: seen.append(f.count()) or f.withColumn("status", F.lit("ok")).withColumnRenamed("url", "checked"))
    assert seen == [1] and sorted(rows_of(out, "pos", "status", "checked"), key=str) == [(0, "ok", "https://example.org/db/"), (1, "ok", "https://example.org/db/"), (2, None, None)]


def test_overlay_and_enrich(spark):
    a = frame(spark, "id int, x string, y string", (1, "a", "b"), (2, "c", "d"))
    b = frame(spark, "id int, x string, y string", (2, None, "new"))
    assert sorted(rows_of(link.overlay(a, b, "id"), "id", "x", "y")) == [(1, "a", "b"), (2, None, "new")]
    assert sorted(rows_of(link.enrich(a, b.select("id", F.col("y").alias("n")), "id", ["n"]), "id", "n", "agent_reviewed"), key=str) == [(1, None, "no"), (2, "new", "yes")]
    with pytest.raises(ValueError):
        link.enrich(a, b.union(b).select("id", F.col("y").alias("n")), "id", ["n"])
    assert rows_of(link.changed_rows(a, a.withColumn("x", F.when(F.col("id") == 2, F.lit("z")).otherwise(F.col("x"))), "id", ["x", "y"]), "id", "column", "was", "now") == [(2, "x", "c", "z")]


def test_max_by_lookup(spark):
    df = frame(spark, "id int, doi string", (1, "10.1/A;10.1/b"), (2, "unknown"), (3, "10.1/zz"))
    cache = frame(spark, "doi string, count long", ("10.1/a", 18), ("10.1/B", 42), ("10.1/zz", None))
    out = link.max_by_lookup(df, "id", F.split("doi", ";"), cache, "doi", "count", "best")
    assert sorted(rows_of(out, "id", "best"), key=str) == [(1, 42), (2, None), (3, None)]


# ---- resolution


def test_components_are_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(40)] + [(9, 9), (None, 3)]
    parent = list(range(500))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges[:-1]:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert got == {x: find(x) for e in edges[:-1] for x in e}
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def catalog_rows(spark, *rows):
    return frame(spark, "id string, database_name string, database_url string, db_type_confirmation string, original48 string", *rows)


def test_duplicate_names_and_addresses(spark):
    df = catalog_rows(spark, ("1", "CATBASE", "https://a.org/x", "yes", "no"), ("2", "CATBASE database", "https://b.org", "YES", "yes"), ("3", "catbase db", "none", "no", "no"), ("4", "Other: atlas", "http://www.c.org/", "yes", "no"), ("5", "none", "https://c.org", "yes", "no"), ("6", "Portal", "https://ncbi.org/p", "yes", "no"))
    got = sorted(rows_of(resolve.catalog_duplicates(df, None), "id", "group", "members", "candidate_count", "match_basis"))
    assert got == [("1", "dup_0001", "1;2", 2, "name"), ("2", "dup_0001", "1;2", 2, "name"), ("4", "dup_0002", "4;5", 2, "url"), ("5", "dup_0002", "4;5", 2, "url")]
    audit = frame(spark, "id string, status string, final_url string", ("1", "reachable", "http://z.org/q/"), ("6", "restricted", "https://www.z.org/q"), ("4", "unreachable", "https://z.org/q"))
    got = {r.id: (r.members, r.match_basis) for r in resolve.catalog_duplicates(df, audit).collect()}
    assert got["1"] == ("1;2;6", "transitive") and got["4"] == ("4;5", "url")
    with pytest.raises(ValueError):
        resolve.catalog_duplicates(df.union(df), None)


def test_name_keys(spark):
    df = frame(spark, "n string", ("ABC-1: A Big Catalog (Alias_2) v 2.1 Database DB",), ("n/a",), ("Resource",), ("Cats & Dogs (two words)",))
    got = [sorted(r[0]) for r in df.select(resolve.name_keys(F.col("n"))).collect()]
    assert got == [["abc1", "abc1abigcatalogalias2", "alias2"], [], [], ["catsanddogstwowords"]]


def test_merge_decisions(spark):
    df = catalog_rows(spark, ("1", "A", "", "yes", "yes"), ("2", "A", "", "yes", "no"), ("3", "B", "", "yes", "no"))
    kept, removed = resolve.apply_merges(df, frame(spark, "id string, representative string", ("1", "2")), "id", "original48")
    assert sorted(rows_of(kept, "id", "original48")) == [("2", "yes"), ("3", "no")] and rows_of(removed, "id", "representative") == [("1", "2")]
    decisions = frame(spark, "group string, id string, action string, canonical string, representative string", ("g", "1", "merge", "A", "1"), ("g", "2", "merge", "A", "9"), ("h", "3", "split", "B", "3"), ("h", "4", "split", "C", "4"))
    assert sorted(rows_of(resolve.check_decisions(decisions), "group", "rule")) == [("g", "foreign_representative"), ("g", "several_representatives")]


def test_canonical_groups_by_a_table_of_candidates(spark):
    rows = [("1", "g", "A", "1", "1; 2"), ("2.0", "g", "A", "1", "1; 2"), ("3", "h", "B", "3", "4;5"), ("4", "h", "C", "4", "4;5"), ("5", "h", "C", "5", "4;5"), ("6", " ", "D", "7", "6"), ("8", None, "E", "8", "8")]
    df = frame(spark, "id string, group string, canonical string, representative string, members string", *rows).withColumn("original48", F.lit("no"))
    candidates = frame(spark, "group string, id string", ("g ", "1"), ("g", "2"), ("g", "2"), ("g", "9"), ("h", "4"), ("h", "5"), (None, "3"))
    columns = ("group_key", "canonical", "representative", "member_ids", "removed_ids", "member_count", "flag", "rule")
    by_list = sorted(rows_of(resolve.canonical_groups(df), *columns))
    by_table = sorted(rows_of(resolve.canonical_groups(df.drop("members"), candidates=candidates), *columns))
    assert by_table == by_list
    assert [(r[0], r[3], r[7]) for r in by_table] == [("g", "1;2", None), ("h", "3", "outside its candidate group"), ("h", "4;5", "several representatives"), ("row:6", "6", "representative is no member"), ("row:8", "8", None)]


def test_canonical_groups_repeats_no_list(spark, tmp_path):
    from sievemill.plans import rule_queries

    n = 3000  # one group, whose rows would hold 3,000 times a list of 3,000 ids
    spark.range(n).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey"), F.lit("A").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    before = written()
    out = rule_queries.canonical_groups(spark, str(tmp_path))
    out.write.format("noop").mode("overwrite").save()
    assert written() - before < 200 * n
    assert out.filter("rule is null and member_count = 1").count() == n


def test_incremental_groups(spark):
    df = frame(spark, "id int", (1,), (2,), (3,), (4,))
    out = resolve.incremental_groups(df, frame(spark, "id int, name string", (1, "a"), (2, "a")), frame(spark, "id int, group string", (2, "g"), (3, "g"), (4, "h")))
    assert sorted(rows_of(out, "id", "group", "members")) == [(i, "incremental_dup_0001", "1;2;3") for i in (1, 2, 3)]
    with pytest.raises(ValueError):
        resolve.incremental_groups(df, frame(spark, "id int, name string", (9, "a"), (1, "a")), frame(spark, "id int, group string", (2, "g")))


def test_incremental_groups_makes_a_large_group_in_several_tasks(spark):
    n = 20_001  # three pieces
    ids = spark.range(n + 3).select(F.col("id").cast("int").alias("id"))
    # as for tables that are too large to be sent to every task; of 4 partitions all three pieces fall to one
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        out = resolve.incremental_groups(ids, ids.filter(f"id < {n}").withColumn("name", F.lit("a")), ids.filter(f"id >= {n} and id < {n + 2}").withColumn("group", F.lit("g")))
        parts = out.groupBy("group", F.spark_partition_id().alias("part")).count().collect()
        rows = out.groupBy("group").agg(F.countDistinct("id"), F.min("id"), F.max("id"), F.count("*"), F.collect_set(F.md5("members"))).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len([p for p in parts if p[0] == "incremental_dup_0001"]) > 1
    digest = lambda of: hashlib.md5(";".join(map(str, of)).encode()).hexdigest()
    assert sorted(map(tuple, rows)) == [("incremental_dup_0001", n, 0, n - 1, n, [digest(range(n))]), ("incremental_dup_0002", 2, n, n + 1, 2, [digest((n, n + 1))])]


def test_incremental_groups_are_stored_with_a_list_once_in_a_file(spark, tmp_path, monkeypatch):
    n = 300  # ids of 5 KB make a list of 1.5 MB, more than a writer's dictionary has by default
    monkeypatch.setattr(resolve, "PIECE_ROWS", 100)
    ids = spark.range(n).select(F.concat(*[F.md5(F.concat_ws("-", "id", F.lit(i))) for i in range(160)]).alias("id"))
    before = spark.conf.getAll
    out = resolve.incremental_groups(ids, ids.withColumn("name", F.lit("a")), ids.limit(0).withColumn("group", F.lit("g")))
    out.write.parquet(f"{tmp_path}/out")
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 20_000_000  # the rows have 460 MB
    stored = spark.read.parquet(f"{tmp_path}/out").select("id", F.md5("members").alias("digest")).collect()
    every = sorted(r.id for r in ids.collect())
    assert sorted(r.id for r in stored) == every and {r.digest for r in stored} == {hashlib.md5(";".join(every).encode()).hexdigest()}
    assert spark.conf.getAll == before


# ---- chunks


def test_chunks(spark):
    df = spark.range(205).withColumnRenamed("id", "pos").repartition(5)
    out = chunk.fixed_chunks(df, ["pos"], 100)
    assert sorted(rows_of(out.groupBy("chunk_id").count(), "chunk_id", "count")) == [(1, 100), (2, 100), (3, 5)]
    assert out.filter("pos >= 100 and pos < 200").select("chunk_id").distinct().collect()[0][0] == 2


def test_groups_stay_together(spark):
    df = spark.createDataFrame([(i, "g" if i in (0, 5, 26) else None) for i in range(27)], "pos int, grp string")
    out = {r.pos: r.chunk_id for r in chunk.atomic_chunks(df, "pos", "grp", 2).collect()}
    assert out[0] == out[5] == out[26] == 1 and out[1] == out[2] == 2 and len(out) == 27


def test_runs_and_fill(spark):
    df = frame(spark, "p int, k int, v string", (0, 1, "a"), (0, 2, "a"), (0, 3, "a"), (0, 4, "b"), (0, 5, None), (0, 6, None), (0, 7, "a"))
    assert rows_of(chunk.run_batches(df, ["p"], ["k"], "v", 2).orderBy("k"), "run", "batch_in_run") == [(0, 0), (0, 0), (0, 1), (1, 0), (2, 0), (2, 0), (3, 0)]
    assert rows_of(chunk.forward_fill(df, ["p"], ["k"], ["v"]).orderBy("k"), "v") == ["a", "a", "a", "b", "b", "b", "a"]


def test_manifest_and_merge(spark):
    earlier = frame(spark, "chunk_id string, seq int, status string", ("c1", 1, "invalid"), ("c1", 2, "complete"))
    out = chunk.chunk_manifest(frame(spark, "chunk_id string", ("c1",), ("c2",)), earlier, "seq")
    assert sorted(rows_of(out, "chunk_id", "status")) == [("c1", "complete"), ("c2", "pending")]
    a, b = frame(spark, "id string, x string", ("101", "a"), ("102", "b")), frame(spark, "id string, y string", ("1", "c"), ("2", "d"))
    assert rows_of(chunk.merge_chunks([a, b], "id"), "id") == ["1", "2", "101", "102"]
    with pytest.raises(ValueError):
        chunk.merge_chunks([a, a], "id")


# ---- validation

GOOD = {
    "id": "1", "title": "t", "database_name": "n", "database_url": "https://a.org", "doi": "", "pmid": "", "year": "2020", "original48": "no", "policy_version": "v1", "accessibility": "live",
    "db_type_confirmation": "yes", "confirmation_reason": "ok", "qualification_basis": "splicing_event", "exclusion_code": "not_applicable", "evidence_url": "https://a.org/x",
    "evidence_source_type": "official_database", "evidence_statement": "a statement of twenty chars", "evidence_checked_date": "2026-07-01", "manual_review_needed": "no", "neural_link": "none",
    "focus": "as_focused", "gene_expression_available": "no", "species": "human", "disease_association": "unknown", "developmental_association": "unknown", "tissue_or_brain_region": "liver",
    "cell_type": "unknown", "sequencing_resolution": "bulk", "read_technology": "short", "visualization_methods": "browser",
}


def curated(spark, n=1, **cells):
    rows = [{**GOOD, "id": str(i + 1), **(cells if i == 0 else {})} for i in range(n)]
    return spark.createDataFrame([(i, *r.values()) for i, r in enumerate(rows)], "pos int, " + ", ".join(f"{c} string" for c in GOOD))


BROKEN = [
    ({"accessibility": "maybe"}, "accessibility has invalid values"), ({"confirmation_reason": " "}, "confirmation_reason is blank"), ({"confirmation_reason": "x" * 81}, "1-80 characters"),
    ({"evidence_checked_date": "2026-7-1"}, "invalid evidence date"), ({"evidence_checked_date": "2026-02-30"}, "invalid evidence date"), ({"exclusion_code": "paper_only"}, "inconsistent yes decision"),
    ({"species": "none"}, "species has forbidden values"), ({"species": "Multiple species"}, "species has placeholder terms"), ({"read_technology": "short;long"}, "read_technology has invalid values"),
    ({"disease_association": "Unclear"}, "disease_association has forbidden values"), ({"qualification_basis": "splicing_event;not_applicable"}, "qualification_basis has invalid values"),
    ({"db_type_confirmation": "no"}, "inconsistent no decision"), ({"evidence_statement": "short"}, "20-300 characters"), ({"evidence_url": "ftp://x"}, "invalid evidence URL"), ({"focus": "transcriptomics_general"}, "inconsistent yes decision"),
]


def test_a_good_chunk_is_complete(spark):
    df = curated(spark, 2, read_technology="long;short")
    assert validate.validate_chunk(df, df, "pos", list(GOOD), list(GOOD)[:9]) == {"status": "complete", "input_rows": 2, "result_rows": 2, "error": ""}


def test_the_first_failing_rule_is_reported(spark):
    rows = [{**GOOD, **cells} for cells, _ in BROKEN]
    df = spark.createDataFrame([(i, *r.values()) for i, r in enumerate(rows)], "pos int, " + ", ".join(f"{c} string" for c in GOOD))
    found = validate.violations(df, "pos", "id", validate.curation_rules()).collect()
    for i, (cells, want) in enumerate(BROKEN):
        first = min((r for r in found if r.row_pos == i), key=lambda r: r.rule_no)
        assert want in f"{first.column} {first.rule}", (cells, first)
    few = spark.createDataFrame([(0, "1", "x", ""), (1, "2", "", "")], "pos int, id string, a string, b string")
    first = validate.first_failing_rule(validate.violations(few, "pos", "id", validate.required_rules(["a", "b"])))
    assert rows_of(first, "row_pos", "column") == [(1, "a")]


def test_chunk_checks(spark):
    df = curated(spark, 3)
    check = lambda result: validate.validate_chunk(result, df, "pos", list(GOOD), list(GOOD)[:9])["error"]
    assert "missing columns: focus" in check(df.drop("focus")) and "expected 3 rows" in check(df.limit(2))
    assert "database_url changed" in check(curated(spark, 3, database_url="https://b.org"))
    review = {"db_type_confirmation": "no", "manual_review_needed": "yes", "exclusion_code": "insufficient_evidence", "qualification_basis": "not_applicable", "focus": "unknown"}
    assert "manual review limit exceeded: 1/3" in check(curated(spark, 3, **review))
    assert [validate.chunk_review_limit(n) for n in (19, 20)] == [0, 1] and [validate.final_review_limit(n) for n in (0, 1, 20, 21)] == [0, 1, 1, 2]


def test_final_rules(spark):
    df = curated(spark, 1, tissue_or_brain_region="renal cortex", accessibility="dead")
    assert rows_of(validate.violations(df, "pos", "id", validate.final_evidence_rules()), "rule") == ["dead evidence must be publication"]
    neural = lambda d: rows_of(validate.violations(d, "pos", "id", validate.final_decision_rules(["tissue_or_brain_region"])), "rule")
    assert neural(df) == [] and neural(curated(spark, 1, tissue_or_brain_region="Hippocampus")) == ["none conflicts with neural metadata"]
    fixed = validate.consistent_neural_link(curated(spark, 1, tissue_or_brain_region="brain"), ["tissue_or_brain_region"])
    assert rows_of(fixed, "neural_link") == ["partial"]


def test_messages_are_capped(spark):
    df = spark.createDataFrame([(i, str(i), "") for i in range(60)], "pos int, id string, c string")
    text = validate.first_messages(validate.violations(df, "pos", "id", validate.required_rules(["c"])), 50, True)
    assert text.startswith("Excel row 2, id=0: c is blank") and text.endswith("... 10 more")


# ---- catalogs and searches

HEADERS = ["<hidden,t-word> id", "<main,t-word> name", "<main,t-word-tag> species", "<expand,t-word-doi> doi", "<main,t-word-url> url", "<main,t-numeric> year", "<main,t-numeric-cite> cited", "<main,t-bool> expressed", "<main,t-bool-access> access"]
EXPECTED = [("name", "main", "t-word"), ("species", "main", "t-word-tag"), ("doi", "expand", "t-word-doi"), ("url", "main", "t-word-url"), ("year", "main", "t-numeric"), ("cited", "main", "t-numeric-cite"), ("expressed", "main", "t-bool"), ("access", "main", "t-bool-access")]


def test_load_catalog(spark):
    headers = [*HEADERS[1:], HEADERS[0]]
    schema = "pos int, " + ", ".join(f"`{h}` string" for h in headers)
    df = frame(spark, schema, (0, "A", "brain; x;Brain", "doi:10.1000/A; https://doi.org/10.1000/b", "https://a.org", "2020", "", "yes", "", "1"), (1, "B", "", "unknown", None, "", "7", "", None, "2"))
    cites = frame(spark, "doi string, count long", ("10.1000/a", 18), ("10.1000/b", 42))
    access = frame(spark, "url_key string, accessible boolean", ("//a.org/", True))
    rows, meta = catalog.load(df, EXPECTED, "pos", cites, access)
    got = {r.id: r for r in rows.collect()}
    assert (got["1"].species, got["1"].doi, got["1"].cited, got["1"].access, got["1"].expressed, got["1"].year) == ("brain;x", "10.1000/A;10.1000/b", 42, True, True, 2020.0)
    assert (got["2"].species, got["2"].doi, got["2"].cited, got["2"].access, got["2"].expressed) == (None, None, None, False, None)
    assert meta.filter("is_citation").first().column_name == "cited"
    bad = df.withColumn(headers[4], F.lit("n"))
    with pytest.raises(ValueError, match="Excel row 2, id=1: year not a number"):
        catalog.load(bad, EXPECTED, "pos")


def test_schema_errors():
    fields = [catalog.parse_header(h, i) for i, h in enumerate(["<main,t-word> Name", "id <main,t-word>", "<main,t-word,hidden> a", "<t-word> b", "<main,odd> c", "<hidden,t-word> d", "<main,t-word> d"])]
    text = catalog.error_text(catalog.schema_errors(fields, []))
    for part in ("not snake_case", "tags must come before", "exactly one position", "unknown tag odd", "used before, in column 6", "display column after hidden column d"):
        assert part in text
    assert catalog.error_text([str(i) for i in range(60)]).endswith("... 10 more")


def search_table(spark):
    df = frame(spark, "id int, name string, species string, secret string, cited double, live boolean, main_collection string", (1, "ÉAlpha_1", "Human; mouse", "zz", 42.0, True, " YES "), (2, "beta%", "human", "alpha", None, None, None), (3, None, None, None, 7.0, False, "no"))
    meta = frame(spark, "column_name string, display_group string, order_index int", ("name", "main", 1), ("id", "main", 0), ("species", "expand", 2), ("cited", "main", 3), ("live", "main", 4), ("secret", "hidden", 5))
    return df, meta


def ids(out):
    return sorted(rows_of(out, "id"))


def test_search(spark):
    df, meta = search_table(spark)
    find = lambda **k: ids(search.search(df, search.Request(**k), meta))
    assert find() == [1, 2, 3] and find(keyword="ALPHA") == [1] and find(keyword="a_1") == [1] and find(keyword="é") == []
    assert find(keyword="%") == [1, 2, 3] and find(keyword="42.0") == [1] and find(keyword="zz") == [] and find(keyword="\\") == []
    assert find(dataset="main") == [1] and find(dataset="odd") == [1, 2, 3]
    assert find(tags={"species": " HUMAN"}) == [1, 2] and find(tags={"species": "mouse", "name": "x"}) == []
    assert find(flags={"live": True}) == [1] and find(flags={"live": False}) == [3]
    assert rows_of(search.search(df, search.Request(sort="cited", descending=True), meta, "id"), "id") == [1, 3, 2]
    assert rows_of(search.search(df, search.Request(sort="cited", top=2), meta, "id"), "id") == [3, 1]
    assert search.search(df, search.Request(), None).columns == df.columns


def test_facets(spark):
    df = spark.createDataFrame([(";".join(f"t{i:02}" for i in range(55)),), ("T00; t01",), (None,)], "tags string")
    out = search.facets(df, ["tags"])
    assert out.count() == 56 and out.filter("preview").count() == 50 and {r.n_more for r in out.collect()} == {6}


# ---- statistics


def test_coverage_and_unknown(spark):
    labels = frame(spark, "id int, label string", (1, "a"), (2, "a"), (2, "b"), (1, "Unknown"), (3, "c"), (3, "c"))
    out = stats.top_with_unknown(stats.coverage(labels, 4), 2)
    assert rows_of(out, "rank", "label", "n", "pct") == [(1, "a", 2, 50.0), (2, "b", 1, 25.0), (3, "Unknown", 1, 25.0)]


def test_years(spark):
    df = frame(spark, "y int", (2001,), (2003,), (2003,), (None,))
    out = stats.by_year(df, F.col("y"), 4).orderBy("position")
    assert rows_of(out, "label", "n") == [("2001", 1), ("2002", 0), ("2003", 2), ("Unknown", 1)]
    assert rows_of(stats.peak(out), "peak_year", "peak_n", "first_year", "last_year") == [("2003", 2, 2001, 2003)]
    assert rows_of(stats.by_year(df.limit(0), F.col("y"), 1), "label", "n") == [("Unknown", 0)]


def test_two_levels(spark):
    raw = frame(spark, "pos int, A string, B string, C string, D string", (0, "I", "First", "I_1", "x"), (1, None, None, "I_2", "y"), (2, "II", "Second", "II_1", "z"), (3, None, None, None, None))
    dimension = stats.fill_dimension(raw, "pos", [{"nope": "code"}, {"A": "major_code", "B": "major_label", "C": "code", "D": "sub_label"}]).withColumnRenamed("pos", "position")
    assert rows_of(dimension.orderBy("position"), "major_code") == ["I", "I", "II"]
    labels = frame(spark, "id int, label string", (1, "I_1"), (1, "I_2"), (2, "I_2"))
    out = {(r.level, r.code): r.n for r in stats.two_levels(labels, dimension, 2).collect()}
    assert out == {("sub", "I_1"): 1, ("sub", "I_2"): 2, ("sub", "II_1"): 0, ("major", "I"): 2, ("major", "II"): 0}
    assert stats.unknown_codes(frame(spark, "id int, label string", (1, "X")), dimension).count() == 1


def test_breakdowns(spark):
    df = frame(spark, "id int, c string", (1, "Bulk; single_cell"), (2, "single_cell;bulk"), (3, "bulk"), (4, "odd"))
    known = {"bulk;single_cell": "Both", "bulk": "Bulk"}
    assert rows_of(stats.token_sets(df, "c", known, "None").orderBy("id"), "label") == ["Both", "Both", "Bulk", "None"]
    with pytest.raises(ValueError, match="c has sets without a label"):
        stats.token_sets(df, "c", known)
    counts = stats.exclusive(df, F.when(F.col("id") < 3, F.lit("x")).otherwise(F.lit("y")), 4)
    assert rows_of(stats.ordered(counts, ["y", "x"]), "label", "n", "pct") == [("y", 2, 50.0), ("x", 2, 50.0)]
    with pytest.raises(ValueError):
        stats.ordered(counts, ["x"])
    assert validate.totals_differ({"a": counts, "b": counts.limit(1)}, 4) == ["b"]
    assert rows_of(frame(spark, "c string", ("a;A",), ("unknown",), ("a",)).select(stats.how_many(None, "c").alias("m")), "m") == ["Multiple", "Unknown", "Single"]


def test_summaries(spark):
    df = frame(spark, "AI_check string, tokens string", ("Yes", "3"), ("no", "x"), (None, None))
    assert rows_of(summary.classification_summary(df, ["tokens", "gone"]), "rows", "n_yes", "n_no", "tokens", "gone") == [(3, 1, 1, 3, 0)]
    manifest = frame(spark, "chunk_id string, status string", ("a", "complete"), ("b", "pending"))
    out = summary.chunk_summary(manifest).first()
    assert (out.chunks, out.complete, out.merge_ready, [p.chunk_id for p in out.pending]) == (2, 1, False, ["b"])
    report = summary.loader_report(frame(spark, "doi string, tags string, accessible boolean", ("10.1/a;10.1/b", "x;X", True), (None, "y", None)), "doi", ["tags"])
    assert dict(rows_of(report, "metric", "value")) == {"rows": 2, "doi_rows": 1, "multi_doi_rows": 1, "reachable": 1, "unreachable": 0, "missing": 1, "tags_tags": 2}


def test_review_queue(spark):
    df = curated(spark, 3).withColumn("db_type_confirmation", F.lit("no"))
    audit = frame(spark, "id string, status string, final_url string, evidence_status string, tls_warning string", ("1", "reachable", "http://www.a.org/", "reachable", ""), ("2", "reachable", "http://b.org", "reachable", ""), ("3", "reachable", "http://a.org", "reachable", "expired"))
    out = summary.review_queue(df, frame(spark, "id string, group string, members string"), audit)
    assert sorted(rows_of(out, "id", "needs_review")) == [("1", False), ("2", True), ("3", True)]


def test_hosts(spark):
    assert frame(spark, "u string", ("http://WWW.A.org:80/x",)).select(urls.host(F.col("u"))).first()[0] == "a.org"
