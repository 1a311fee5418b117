"""Services that answer badly, runs that pause, catalogs with bad ids, decisions that leave duplicates."""

import pytest
from pyspark.sql import functions as F
from test_sources import article, config

from sievemill.operators import catalog, link, resolve, stats, validate
from sievemill.plans import funnel, state
from sievemill.sources import services, shared_tables


def dois(spark, *found):
    return spark.createDataFrame([(d,) for d in found], "doi string").coalesce(1)


def test_a_short_or_refused_batch_has_no_counts_and_no_single_calls(spark):
    counts = {"10.1/a": 1, "10.1/b": 2, "10.1/c": 3}

    def short(r):
        if "dois" not in r:
            raise AssertionError("asked singly")
        return {"results": [{"citationCount": counts[d]} for d in r["dois"][1:]]}

    refused = lambda r: {"status_code": 404} if "dois" in r else {"citationCount": 9}
    for ask in (short, refused):
        assert {(r.doi, r["count"]) for r in services.citation_counts(dois(spark, *counts), ask).collect()} == {(d, None) for d in counts}
    good = lambda r: {"results": [{"citationCount": counts[d]} if d != "10.1/b" else None for d in r["dois"]]} if "dois" in r else {"status_code": 404, "citationCount": 7}
    assert {(r.doi, r["count"]) for r in services.citation_counts(dois(spark, *counts), good).collect()} == {("10.1/a", 1), ("10.1/b", None), ("10.1/c", 3)}


def test_cursors_that_cycle_end():
    after = {"*": "A", "A": "B", "B": "A"}
    asked = []
    turn = lambda r: asked.append(r["cursorMark"]) or {"resultList": {"result": [{}]}, "nextCursorMark": after[r["cursorMark"]]}
    assert len(list(services.pages(turn, "q"))) == 3 and asked == ["*", "A", "B"]


def test_json_requests():
    t = services.JsonTransport("https://h.org/{source}/{id}", {"format": "json"})
    r = t.request({"source": "MED", "id": "1/2", "page": 3})
    assert r.full_url == "https://h.org/MED/1%2F2?format=json&page=3" and r.data is None
    posted = services.JsonTransport("https://h.org/batch").request({"dois": ["10.1/a"]})
    assert posted.full_url == "https://h.org/batch" and posted.data == b'{"ids": ["DOI:10.1/a"]}'


def yes(request):
    return {"text": '{"AI_class": 1, "AI_reason": "r", "resource_name": "DB"}'}


def test_a_capped_run_goes_on_when_resumed(spark, tmp_path):
    capped = config(tmp_path, most_answers=2)
    capped.transports["model"] = yes
    with pytest.raises(state.Paused):
        funnel.run(spark, capped)
    paused = state.RunState.open(capped.folder, True)
    assert "classified" not in paused.completed_stages and paused.counts["classified"] == 2
    capped.resume = True
    for _ in range(10):
        try:
            out = funnel.run(spark, capped).count()
            break
        except state.Paused:
            continue
    done = state.RunState.open(capped.folder, True)
    assert out == done.counts["classified_targets"] == done.counts["classified"] > 2 and "curation" in done.completed_stages


def test_failures_are_noted_and_come_again(spark, tmp_path):
    first = config(tmp_path)
    n = funnel.run(spark, first).count()
    noted = state.RunState.open(first.folder, True)
    assert noted.counts["classified_failed"] == len([f for f in noted.failures if f["stage"] == "classified"]) > 0
    first.resume, first.transports["model"] = True, yes
    again = funnel.run(spark, first)
    assert again.count() > n and not state.RunState.open(first.folder, True).failed("classified")


def test_state_in_any_file_system(spark, tmp_path):
    folder = f"file:{tmp_path}/run"
    made = state.RunState.open(folder, False, {"policy_version": "v1"})
    made.complete("a", 3, f"{folder}/a")
    assert state.RunState.open(folder, True).counts == {"a": 3}
    with pytest.raises(FileExistsError):
        state.RunState.open(folder, False)
    (tmp_path / "run" / "state.json").rename(tmp_path / "run" / "state.json.new")  # as if stopped before the last step
    assert state.RunState.open(folder, True).counts == {"a": 3}
    calls = []
    stages = state.Stages(spark, folder, True)
    for _ in range(2):
        assert stages.run("b", lambda: calls.append(1) or spark.range(2)).count() == 2
    assert calls == [1]


def test_a_cluster_needs_a_shared_folder():
    assert shared_tables.is_local("local[4]") and shared_tables.is_local("local") and not shared_tables.is_local("local-cluster[3,2,3000]") and not shared_tables.is_local("yarn")


def test_scopes_keep_what_they_are_told(spark):
    with shared_tables.only(spark) as keep:
        one, path = shared_tables.written(spark.range(3), "one")
        _, gone = shared_tables.written(spark.range(3), "two")
        kept = keep(one, path)
    assert kept.count() == 3 and not shared_tables.exists(spark, gone)
    shared_tables.remove(spark, path)


HEADERS = ["<main,t-word> name", "<hidden,t-word> id"]


def test_bad_ids_of_a_catalog(spark):
    load = lambda *ids: catalog.load(spark.createDataFrame([(i, f"n{i}", x) for i, x in enumerate(ids)], "pos int, " + ", ".join(f"`{h}` string" for h in HEADERS)), [("name", "main", "t-word")], "pos")
    with pytest.raises(ValueError, match="Excel row 3, id=1: id is a duplicate; first seen at Excel row 2.*Excel row 4, id=: id is blank"):
        load("1", " 1 ", "")
    rows, meta = load("1", "2")
    assert rows.count() == 2
    catalog.save(rows, meta, "catalog_one", "catalog_two")
    assert catalog.saved(spark, "catalog_one", "catalog_two")[0].count() == 2
    with pytest.raises(LookupError, match="nowhere"):
        catalog.saved(spark, "nowhere", "catalog_two")


def test_landscape(spark):
    cols = validate.LANDSCAPE_COLUMNS
    good = dict.fromkeys(cols, "x") | {"id": "1", "name": "a", "year": "2020", "accessibility": "Live", "resolution": "bulk; single_cell", "read": ""}
    frame = lambda *rows: spark.createDataFrame([(i, *r.values()) for i, r in enumerate(rows)], "pos int, " + ", ".join(f"{c} string" for c in cols))
    assert validate.check_landscape(frame(good, {**good, "id": "2", "name": "b", "year": None}), "pos", 2026).count() == 2
    for cells, text in (({"name": "a"}, "duplicate"), ({"name": ""}, "missing"), ({"year": "2027"}, "out of range"), ({"read": "medium"}, "unknown tags"), ({"id": None}, "blank")):
        with pytest.raises(ValueError, match=text):
            validate.check_landscape(frame(good, {**good, "id": "2", "name": "b", **cells}), "pos", 2026)
    with pytest.raises(ValueError, match="missing columns: read"):
        validate.check_landscape(frame(good).drop("read"), "pos", 2026)


def test_decisions_that_leave_duplicates(spark):
    cols = "id string, database_name string, database_url string, db_type_confirmation string, original48 string"
    final = spark.createDataFrame([("1", "Atlas", "", "yes", "yes"), ("2", "Atlas", "", "yes", "no"), ("3", "Other", "", "yes", "no")], cols)
    decide = lambda *rows: spark.createDataFrame(list(rows), "group string, id string, action string, canonical string, representative string")
    g = "incremental_dup_0001"
    kept, audit = resolve.apply_incremental(final, decide((g, "1", "merge", "Atlas", "2"), (g, "2", "merge", "Atlas", "2")))
    assert sorted((r.id, r.original48) for r in kept.collect()) == [("2", "yes"), ("3", "no")]
    assert [tuple(r) for r in audit.select("representative", "member_ids", "removed_ids", "member_count").collect()] == [("2", "1;2", "1", 2)]
    split = decide((g, "1", "split", "Atlas A", "1"), (g, "2", "split", "Atlas B", "2"))
    assert resolve.apply_incremental(final, split)[0].count() == 3
    with pytest.raises(ValueError, match="incremental_dup_0001: id 1 lacks a decision"):
        resolve.apply_incremental(final, decide((g, "2", "split", "Other", "2")))
    with pytest.raises(ValueError, match="h: id 3 is no candidate"):
        resolve.apply_incremental(final, decide((g, "1", "merge", "Atlas", "2"), (g, "2", "merge", "Atlas", "2"), ("h", "3", "split", "Other", "3")))
    with pytest.raises(ValueError, match="decided twice"):
        resolve.apply_incremental(final, decide((g, "1", "merge", "Atlas", "2"), (g, "1", "merge", "Atlas", "2"), (g, "2", "merge", "Atlas", "2")))
    with pytest.raises(ValueError, match="foreign_representative"):
        resolve.apply_incremental(final, decide((g, "1", "merge", "Atlas", "3"), (g, "2", "merge", "Atlas", "3")))
    named = spark.createDataFrame([("Q", "1"), ("Q", "3"), ("R", "2")], "name string, representative string")
    three = [(r.id, r.members) for r in resolve.incremental_candidates(final, named).orderBy("id").collect()]
    assert three == [("1", "1;2;3"), ("2", "1;2;3"), ("3", "1;2;3")]
    chained = spark.createDataFrame([("1", "Atlas", "https://x.org", "yes", "no"), ("2", "Atlas", "https://y.org", "yes", "no"), ("3", "Other", "https://y.org", "yes", "no")], cols)
    left = decide((g, "1", "merge", "A", "1"), (g, "2", "merge", "A", "1"), (g, "3", "merge", "A", "1"))
    assert [r.id for r in resolve.apply_incremental(chained, left)[0].collect()] == ["1"]


def test_curated_rows_as_input_again(spark):
    row = dict.fromkeys(funnel.CURATION, "x") | {"id": "7.0", "year": "2020.0", "original48": "YES", "doi": " nan"}
    df = spark.createDataFrame([(0, *row.values())], "pos int, " + ", ".join(f"{c} string" for c in row))
    out = funnel.curated_again(df, "v9").first()
    assert (out.id, out.year, out.original48, out.doi, out.title, out.policy_version, out.species, out.focus) == ("7", "2020", "yes", "", "x", "v9", "", "")
    with pytest.raises(ValueError, match="duplicate"):
        funnel.curated_again(df.union(df.withColumn("pos", F.lit(1))), "v9")


def test_lookups_and_labels(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, "last", 2)], "k int, v string, s int")
    targets = spark.createDataFrame([(2, 0), (1, 1), (9, 2)], "k int, p int")
    assert [(r.k, r.v) for r in link.in_target_order(rows, targets, "k", "p", "s").collect()] == [(2, "b"), (1, "last")]
    with pytest.raises(ValueError, match="3 rows, but 2"):
        link.append_columns(rows, targets.limit(2), "k")
    with pytest.raises(ValueError, match="other values: maybe"):
        stats.yes_no_labels(spark.createDataFrame([("Yes",), ("maybe",)], "c string"), "c")


def test_review_manifest(spark):
    one = spark.createDataFrame([(0, "1")], "pos int, id string")
    check = lambda result, source: {"status": "pending" if result is None else "complete", "input_rows": 1, "result_rows": 1, "error": ""}
    out = validate.review_manifest(spark, {"b": (one, one), "a": (one, None)}, None, "v1", check)
    assert [(r.chunk_id, r.status) for r in out.orderBy("chunk_id").collect()] == [("a", "pending"), ("b", "complete")]
    with pytest.raises(ValueError, match="policy version is v1"):
        validate.review_manifest(spark, {}, out, "v2", check)
    assert validate.validate_chunk(None, one, "pos", ["id"], ["id"])["status"] == "pending"
    assert "unknown columns: x" in validate.validate_chunk(one.withColumn("x", F.lit(1)), one, "pos", ["id"], ["id"])["error"]
    assert validate.validate_final_review(one.withColumn("x", F.lit(1)), one, "pos", ["id"], ["id"], [])["error"] == "schema mismatch"


def test_article_helper():
    assert article(1)["pmid"] == "101"
