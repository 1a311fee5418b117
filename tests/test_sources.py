import json

import pytest
from pyspark.sql import functions as F

from sievemill.functions import ids
from sievemill.operators import dedup, screen
from sievemill.plans import funnel, state
from sievemill.sources import files, services
from sievemill.sources.shared_tables import remove, written
from sievemill.streaming import screening


def article(k, **more):
    return {"title": f"Splicing database {k}", "doi": f"10.1/{k}", "pubYear": "2020", "journalInfo": {"journal": {"title": "J"}}, "citedByCount": str(k), "pmid": str(100 + k), "source": "MED", "abstractText": "rna www.db.org/x", "id": str(100 + k), **more}


def search(request):
    start = 0 if request.get("cursorMark", "*") == "*" else int(request["cursorMark"])
    return {"resultList": {"result": [article(k) for k in range(start, min(start + 2, 5))]}, "nextCursorMark": str(min(start + 2, 5))}


def test_pages_end():
    assert len(list(services.pages(search, "q", 2))) == 5 and len(list(services.pages(search, "q", 2, 3))) == 3
    calls = []
    list(services.pages(lambda r: calls.append(r["pageSize"]) or {}, "q", 5000))
    assert calls == [1000]
    same = lambda r: {"resultList": {"result": [{}]}, "nextCursorMark": r["cursorMark"]}
    assert len(list(services.pages(same, "q"))) == 1


def test_years():
    assert services.parse_years("2001-2003") == [2001, 2002, 2003] and services.parse_years("2003-2002") == [2003, 2002] and services.parse_years("1, 5,") == [1, 5]
    assert services.year_query("q", 2020) == "q AND PUB_YEAR:[2019 TO 2020]"


def test_search_years(spark):
    rows = services.search_years(spark, search, "q", [2020, 2021], most_per_year=3, page_size=2).collect()
    assert len(rows) == 6 and {r.year_window for r in rows} == {2020, 2021} and rows[0].web == "https://doi.org/10.1/0"


def test_article_expressions(spark):
    raw = [article(3, journalInfo={}), {"title": None, "citedByCount": "x"}]
    df = spark.createDataFrame([(i, json.dumps(a)) for i, a in enumerate(raw)], "i int, raw string")
    out = services.article_records(df, "raw").orderBy("i").collect()
    assert (out[0].journal, out[0].citedByCount, out[0].web, out[1].title, out[1].citedByCount, out[1].web) == ("", 3, "https://doi.org/10.1/3", "", 0, "")


def references(request):
    if request["pmid"] == "bad":
        raise RuntimeError("refused")
    return {"referenceList": {"reference": [{"source": "MED", "id": request["pmid"] + str(request["page"]), "title": "r"}] if request["page"] < 3 else []}}


def test_references(spark):
    rows = services.fetch_references(spark.createDataFrame([("1",), ("bad",)], "pmid string"), references, rate=0).collect()
    assert sorted((r.seed_pmid, r.ref_id, r.error != "") for r in rows if r.seed_pmid == "1") == [("1", "11", False), ("1", "12", False)]
    assert [r.seed_pmid for r in rows if r.error] == ["bad"]


def details(request):
    if "query" in request:
        return {"resultList": {"result": [article(1, id="1"), article(1, id="1", title="again")]}}
    if request["id"] == "3":
        raise RuntimeError("gone")
    return {"result": article(2, id=request["id"])}


def test_details_match_by_key(spark):
    targets = spark.createDataFrame([("MED", "1"), ("MED", "2"), ("MED", "3")], "ref_source string, ref_id string").coalesce(1)
    got = {r.ref_id: (r.title, r.error) for r in services.fetch_details(targets, details).collect()}
    assert got == {"1": ("Splicing database 1", ""), "2": ("Splicing database 2", ""), "3": ("", "gone")}


def test_citations(spark):
    dois = spark.createDataFrame([("10.1/A",), ("10.1/a",), ("10.1/b",), (None,)], "doi string").coalesce(1)
    ask = lambda r: {"results": [{"citationCount": 4} if d.endswith("a") else None for d in r["dois"]]} if "dois" in r else {"citationCount": 7}
    assert sorted(tuple(r) for r in services.citation_counts(dois, ask).collect()) == [("10.1/a", 4), ("10.1/b", 7)]

    def down(r):
        raise RuntimeError("down")

    assert {r["count"] for r in services.citation_counts(dois, down).collect()} == {None}


def test_retries_and_rates():
    tries, slept = [], []
    assert services.with_retries(lambda: tries.append(1) or {"status_code": 503 if len(tries) < 3 else 200}, sleep=slept.append)["status_code"] == 200 and slept == [1.0, 2.0]
    with pytest.raises(ValueError):
        services.with_retries(lambda: int("x"), 2, slept.append)
    now, waits = [0.0], []
    gate = services.RateLimit(2, 1, lambda: now[0], lambda s: waits.append(s))
    gate.wait()
    gate.wait()
    assert waits == [0.5]


def web(request):
    if "secure" in request["url"] and request["verify"]:
        raise RuntimeError("certificate expired")
    if "dead" in request["url"]:
        raise RuntimeError("no host")
    return {"status_code": 404 if "missing" in request["url"] else 200, "url": request["url"] + "#final", "text": "Verify you are human" if "robot" in request["url"] else "ok", "history": [{"url": request["url"]}]}


def test_liveness(spark):
    names = ["a.org", "secure.org", "dead.org", "missing.org", "robot.org"]
    df = spark.createDataFrame([(n, n) for n in names], "url_key string, url string")
    got = {r.url_key: r for r in services.check_urls(df, web).collect()}
    assert {k: r.status for k, r in got.items()} == {"a.org": "reachable", "secure.org": "reachable", "dead.org": "unreachable", "missing.org": "unreachable", "robot.org": "restricted"}
    assert "certificate" in got["secure.org"].tls_warning and got["a.org"].redirect_chain[-1].endswith("#final") and got["dead.org"].error == "no host"


def answers(request):
    if "database 1" in request["prompt"]:
        return {"text": "no json"}
    return {"text": '{"AI_class": 1, "AI_reason": "r", "resource_name": "DB"}', "usage": "{}"}


def config(tmp_path, **more):
    return funnel.Config("q", "2020-2021", str(tmp_path / "run"), transports={"search": search, "references": references, "details": lambda r: {"resultList": {"result": []}} if "query" in r else {"result": article(int(r["id"]), source="MED")}, "model": answers}, **more)


def test_funnel_and_resume(spark, tmp_path):
    out = funnel.run(spark, config(tmp_path)).collect()
    assert out and {r.database_name for r in out} == {"DB"} and {r.database_url for r in out} == {"https://www.db.org/x"} and sorted(int(r.id) for r in out) == list(range(1, len(out) + 1))
    with pytest.raises(FileExistsError):
        funnel.run(spark, config(tmp_path))
    again = funnel.run(spark, config(tmp_path, resume=True)).collect()
    assert len(again) == len(out)
    with pytest.raises(ValueError):
        funnel.run(spark, config(tmp_path, resume=True, policy_version="v2"))
    kept = state.RunState.open(str(tmp_path / "run"), True)
    assert kept.counts["curation"] == len(out) and set(kept.completed_stages) >= {"search", "seeds", "classified"}


def test_answers_are_capped_and_resumed(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}", f"10.1/{i}", "", "", "x") for i in range(3)], "pos int, title string, doi string, pmid string, pmcid string, abstractText string")
    n = [funnel.classify(rows, answers, str(tmp_path / "done"), "v1", most=1).count() for _ in range(4)]
    assert n == [1, 2, 3, 3]


def test_failed_answers_come_again(spark, tmp_path):
    rows = spark.createDataFrame([(1, "database 1", "10.1/1", "", "", "x")], "pos int, title string, doi string, pmid string, pmcid string, abstractText string")
    assert funnel.classify(rows, answers, str(tmp_path / "done"), "v1").count() == 0
    fixed = lambda r: {"text": '{"AI_class": 6}'}
    assert funnel.classify(rows, fixed, str(tmp_path / "done"), "v1").first().AI_check == "No"


FINAL = {
    "id": "1", "database_name": "Atlas", "original48": "no", "accessibility": "live", "db_type_confirmation": "yes", "qualification_basis": "direct_junction", "exclusion_code": "not_applicable", "focus": "as_focused", "gene_expression_available": "no", "manual_review_needed": "no",
    "evidence_url": "https://a.org", "evidence_source_type": "official_database", "evidence_statement": "A statement of some length.", "evidence_checked_date": "2026-01-02", "neural_link": "none", "tissue": "liver",
}
NO = {"db_type_confirmation": "no", "qualification_basis": "not_applicable", "exclusion_code": "out_of_scope", "focus": "unknown"}


def reviewed_row(i, members, canonical, representative, **cells):
    return {**FINAL, "id": i, **cells, "group": "dup_0001" if ";" in members else "", "members": members, "canonical": canonical, "representative": representative}


def table_of(spark, rows, extra=()):
    names = [*FINAL, *extra]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], ", ".join(f"`{c}` string" for c in names))


def finalized(spark, curated, reviewed):
    return funnel.finalize(table_of(spark, curated), table_of(spark, reviewed, ("group", "members", "canonical", "representative")), ["tissue"])


def test_finalize(spark):
    curated = [{**FINAL, "id": "10"}, {**FINAL, "id": "9.0", "original48": "yes"}, {**FINAL, "id": "2", **NO}, {**FINAL, "id": "100"}]
    reviewed = [reviewed_row("10.0", "9;10", "atlas", "10", database_name="New"), reviewed_row("9", "9; 10", "atlas", "10.0", original48="yes"), reviewed_row("100", "100", "own", "100", tissue="cerebral cortex")]
    final, audit = finalized(spark, curated, reviewed)
    assert final.columns == list(FINAL)
    assert [(r.id, r.database_name, r.original48, r.neural_link) for r in final.collect()] == [("2", "Atlas", "no", "none"), ("10", "New", "yes", "none"), ("100", "Atlas", "no", "partial")]
    assert sorted((r.canonical, r.representative, r.member_ids, r.removed_ids, r.member_count, r.flag) for r in audit.collect()) == [("atlas", "10", "9;10", "9", 2, "yes"), ("own", "100", "100", "", 1, "no")]


def test_finalize_rejects(spark):
    one = [{**FINAL, "id": "1"}]
    for reviewed, text in (
        ([], "without a review: 1"),
        ([reviewed_row("1", "1", " ", "1")], "without a review: 1"),
        ([reviewed_row("1", "1", "a", "1"), reviewed_row("1.0", "1", "a", "1")], "reviewed twice: 1"),
        ([reviewed_row("1", "2", "a", "1")], "canonical group a: outside its candidate group"),
        ([reviewed_row("1", "1;2", "a", "2")], "canonical group a: representative is no member"),
        ([reviewed_row("1", "1", "a", "1", evidence_url="none")], "invalid evidence URL"),
        ([reviewed_row("1", "1", "a", "1", evidence_source_type="publication")], "live evidence must be official"),
        ([reviewed_row("1", "1", "a", "1", exclusion_code="x")], "yes excludes nothing"),
    ):
        with pytest.raises(ValueError, match=text):
            finalized(spark, one, reviewed)
    manual = {**NO, "exclusion_code": "insufficient_evidence", "manual_review_needed": "yes"}
    with pytest.raises(ValueError, match="manual review limit exceeded: 2/3"):
        finalized(spark, [{**FINAL, "id": str(k), **(manual if k else NO)} for k in range(3)], [])


def test_an_address_in_a_title_is_found(spark):
    rows = spark.createDataFrame([(0, "MyDB: see https://mydb.org/x", "no address", "https://late.org"), (1, "t", "at https://first.org.", ""), (2, "t", None, "https://last.org")], "pos int, title string, abstractText string, AI_reason string")
    assert [r.database_url for r in funnel.curation_table(rows, "v1").orderBy("pos").collect()] == ["https://mydb.org/x", "https://first.org", "https://last.org"]


def test_ids_are_compared_as_ids(spark):
    a = spark.createDataFrame([(0, "5", "2020", "x"), (1, "7", "2021.0", "y")], "pos int, id string, year string, v string")
    b = spark.createDataFrame([(0, "5.0", "2020.0", "x"), (1, "8", "2021", "y ")], "pos int, id string, year string, v string")
    from sievemill.operators import link

    assert [tuple(r) for r in link.changed_rows(a, b, "pos", ["id", "year", "v"]).collect()] == [(1, "id", "7", "8")]


def test_files(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    assert files.read_csv_rows(spark, path, ["a"]).count() == 0
    (tmp_path / "t.csv").write_text('a,b\n"x\ny",\n007,z\n')
    assert [tuple(r) for r in files.read_csv_rows(spark, path, ["a", "b", "c"]).collect()] == [("x\ny", "", ""), ("007", "z", "")]
    df = spark.createDataFrame([(1, "https://a b"), (2, "https://a.org/x")], "k int, u string")
    assert [tuple(r) for r in files.link_cells(df, ["u"]).collect()] == [("u", "https://a.org/x")]
    one = files.snapshot(df, str(tmp_path / "s"))
    assert one == files.snapshot(df.repartition(3).limit(0), str(tmp_path / "s")) == files.snapshot(df.repartition(2), str(tmp_path / "s2")) and one == one.upper() and len(one) == 64
    files.append_rows(df, str(tmp_path / "p"), ["u", "none"])
    files.append_rows(df, str(tmp_path / "p"), ["u", "none"])
    assert spark.read.parquet(str(tmp_path / "p")).filter("none = ''").count() == 4
    files.write_json_lines(df, str(tmp_path / "j"))
    assert files.read_urls(spark, str(tmp_path / "j"), "u").count() == 2
    files.replace_table(df, "links_made")
    assert spark.table("links_made").count() == 2


def test_written_tables(spark):
    df, path = written(spark.range(5), "five")
    assert df.count() == 5
    remove(spark, path)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(path).count()


def test_stream(spark, tmp_path):
    rows = [("Atlas", "splicing", "2026-01-01 00:00:00"), ("atlas ", "splicing", "2026-01-01 01:00:00"), ("birds", "none", "2026-01-01 02:00:00")]
    df = spark.createDataFrame(rows, "title string, abstractText string, t string").select("title", "abstractText", F.to_timestamp("t").alias("arrived_at"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = screening.append_to(screening.screened_stream(stream, screen.RESOURCE_PATTERN, screen.SCOPE_PATTERN), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_paper_keys(spark):
    df = spark.createDataFrame([(0, "10.1/A", "5", "", "t"), (1, "", "", "PMC1", "t"), (2, None, None, None, None)], "i int, d string, p string, c string, t string")
    assert [r.k for r in df.orderBy("i").select(ids.paper_key(F.col("i"), F.col("d"), F.col("p"), F.col("c"), F.col("t")).alias("k")).collect()] == ["doi:10.1/a", "pmcid:pmc1", "row:2"]
    assert dedup.union_superset(df.select("i", "d"), df.select("i", "t")).count() == 6
