import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievemill.functions import ids, model_output, tags, urls
from sievemill.functions import text as X


@pytest.fixture(scope="module")
def ev(spark):
    def run(f, values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        return [r.o for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]

    return run


def test_missing_regimes(ev):
    v = [None, "", " \t\n", "NaN", "none", "Unknown", "-", " a  b ", "<NA>", "null"]
    assert ev(X.is_blank, v) == [True, True, True, *[False] * 7]
    assert ev(X.is_missing_text, v) == [True, True, True, True, True, True, True, False, True, False]
    assert ev(X.clean, v) == ["", "", "", "NaN", "none", "Unknown", "-", "a  b", "<NA>", "null"]
    assert ev(X.clean_result, v)[3:6] == ["", "", "Unknown"] and ev(X.clean_chunk, v)[3:6] == ["", "none", "Unknown"]
    assert ev(X.identity_value, v) == ["", "", "", "", "", "", "", "a b", "<NA>", ""]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\xa0 abç", max_size=8), max_size=20))
def test_strip_is_python_s(ev, values):
    assert ev(X.strip, values) == [v.strip() for v in values]


def test_numbers_and_identifiers(ev):
    v = ["12.00", "-3.0", "A-7 ", "4.5", "", None, "2024.0", "1e3", "x9.0", "007"]
    assert ev(X.clean_id, v) == ["12", "-3", "A-7", "4.5", "", "", "2024", "1e3", "x9.0", "7"]
    assert ev(X.to_int, v) == [12, -3, 0, 4, 0, 0, 2024, 1000, 0, 7]
    assert ev(X.clean_int_identifier, v) == ["12", "-3", "A-7", "4.5", "", "", "2024", "1000", "x9", "7"]
    assert ev(X.clean_year, v) == ["12", "", "", "", "", "", "2024", "1000", "", "7"]
    assert ev(X.drop_decimal_zero, v)[:2] == ["12.00", "-3.0"] and ev(X.drop_decimal_zero, ["123.0"]) == ["123"]


def test_flags(ev):
    assert ev(X.flag, ["1", "true", "T", "yes", "Y", "0", "false", "f", "NO", "n", "2", "", None, "1.0"]) == [*[True] * 5, *[False] * 5, None, None, None, True]


def test_the_doi_forms_differ(ev):
    v = ["https://doi.org/10.1/A.", "doi: 10.1/A", "http://dx.doi.org/10.1/A", "n/a", "doi:https://doi.org/10.1/A"]
    assert ev(ids.doi_token, v) == ["10.1/A.", "10.1/A", "10.1/A", "", "10.1/A"]
    assert ev(ids.doi_matching, v) == ["10.1/a.", "10.1/a", "10.1/a", "n/a", "https://doi.org/10.1/a"]
    assert ev(ids.doi_identity, v) == ["10.1/a", "10.1/a", "10.1/a", "", "https://doi.org/10.1/a"]
    assert ev(ids.doi_bare, v)[0] == "10.1/A." and ev(ids.doi_bare, v)[2] == v[2]
    assert ev(ids.doi_key, v)[0] == "https://doi.org/10.1/a."
    assert ev(lambda c: ids.web_from_doi(c)[1], ["10.1/A", "", None]) == ["https://doi.org/10.1/A", "", ""]


def test_url_keys(ev):
    v = ["https://WWW.Example.org:8080/a//b/?q=1#f", "example.org", "unknown", "http://e.org:80/", None, "http://u@e.org/x/"]
    assert ev(urls.database_url_key, v) == ["//example.org/a/b?q=1", "//example.org/", "", "//e.org/", "", "//e.org/x"]
    assert ev(urls.url_key, v) == ["//example.org:8080/a//b?q=1", "//example.org/", "//unknown/", "//e.org/", "", "//e.org/x"]


def test_url_candidates(ev):
    assert ev(urls.url_candidates, ["https://example.org/db/#x", "www.a.org", ""]) == [
        ["https://example.org/db/", "https://www.example.org/db/", "http://example.org/db/", "http://www.example.org/db/"],
        ["https://www.a.org", "https://a.org", "http://www.a.org", "http://a.org"],
        [],
    ]


def test_first_database_url(ev):
    v = ["see https://doi.org/10.1/x and (www.db.org/a).", "none", "http://pubmed.ncbi.nlm.nih.gov/1", "HTTPS://X.org/]"]
    assert ev(lambda c: urls.first_database_url(c), v) == ["https://www.db.org/a", "", "", "HTTPS://X.org/"]


def test_page_status(spark):
    rows = [(200, "ok", "reachable"), (403, "<a>Continue</a>", "restricted"), (404, "<a> Continue </a>", "continue_required"), (200, "Verify you are human", "restricted"), (200, "Buy this domain", "restricted"), (404, None, "unreachable"), (429, "", "restricted")]
    df = spark.createDataFrame(rows, "code int, page string, want string")
    assert [r.s for r in df.select(urls.page_status(F.col("code"), F.col("page")).alias("s")).collect()] == [w for *_, w in rows]


def test_tags(ev):
    v = ["brain; cerebellum;brain;BRAIN; ;Spinal", "", None, "a"]
    assert ev(tags.normalize_tags, v) == ["brain;cerebellum;Spinal", None, None, "a"]
    assert ev(lambda c: tags.has_tag(c, " Brain "), v) == [True, False, False, False]
    assert ev(lambda c: tags.set_key(tags.split_tags(c)), ["b;A", "a; B"]) == ["a;b", "a;b"]
    assert ev(tags.normalize_doi, ["doi:10.1/A; https://doi.org/10.1/a;n/a", "unknown"]) == ["10.1/A", None]
    assert ev(tags.doi_links, ["10.1/a; http://x"]) == [["https://doi.org/10.1/a", "http://x"]]


def test_answers(ev):
    v = ['{"AI_check": "yes", "AI_reason": "r"}', '```json\n{"AI_check":"No","AI_reason":"r"}\n```', "Yes", "not json", 'so {"AI_check": "Yes", "AI_reason": "w"} ok', '{"AI_check": "no"}', '{"AI_check": "yes", "AI_reason": ""', None]
    assert ev(lambda c: model_output.parse_check(c)["AI_check"], v) == ["Yes", "No", "Yes", "No", "Yes", "No", "Yes", "No"]
    assert ev(lambda c: model_output.parse_check(c)["AI_reason"], v)[:5] == ["r", "r", model_output.REASON_TEXT, model_output.REASON_INVALID, "w"]
    assert ev(lambda c: model_output.parse_triage(c)["stage1_decision"], ['{"stage1_decision": "Reject it", "stage1_reason": "x"}', '["Pass"]', '{"stage1_decision": "pass", "stage1_reason": ""}']) == ["Reject", "Unclear", "Unclear"]


def test_classifications(ev):
    v = ['{"AI_class": "6", "AI_check": "Yes", "resource_type": "atlas"}', '{"AI_class": 5, "target_scope_hint": "none", "resource_name": ""}', '{"AI_class": 9}', "[1]", '{"AI_class": "x"}', '{"AI_class": 2, "target_scope_hint": "direct_splicing", "url_mentioned": "yes"}']
    got = ev(lambda c: model_output.parse_classification(c, "v"), v)
    assert (got[0].AI_check, got[0].target_scope_hint, got[0].resource_type, got[0].error) == ("No", "none", "atlas", None)
    assert (got[1].target_scope_hint, got[1].resource_name, got[1].resource_type) == ("needs_web_verification", "none", "other")
    assert [g.error for g in got[2:5]] == ["Stage2 response has invalid AI_class: 9", "Model returned no JSON object", "Stage2 response missing valid integer AI_class"]
    assert (got[5].target_scope_hint, got[5].url_mentioned, got[5].AI_check) == ("transcript_model", "Yes", "Yes")


def test_small_formats(ev):
    assert ev(X.sentence_case, ["  parkinson  Disease", ""]) == ["Parkinson Disease", ""]
    assert ev(X.column_header, ["database_url", "main_tag"]) == ["Database URL", "Main Tag"]
    assert ev(X.normalize_title, ["  A  Title. ", None]) == ["a title", ""]
