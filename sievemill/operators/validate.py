"""Validation as data: rules make a table of violations, and its first few make a message."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import ids, tags
from sievemill.functions import text as X

# The curation vocabularies.
QUALIFICATION_BASIS = ["splicing_event", "splice_site_or_junction", "splicing_regulation_or_sqtl", "transcript_or_isoform_model", "transcript_level_abundance"]
DIRECT_SPLICING = ["splicing_event", "splice_site_or_junction", "splicing_regulation_or_sqtl"]
EXCLUSION_CODE = ["not_applicable", "gene_expression_only", "rna_not_transcript_splicing", "no_search_browse_query", "download_or_static_only", "software_or_upload_only", "paper_only", "insufficient_evidence"]
EVIDENCE_SOURCE = ["official_database", "official_documentation", "publication", "web_archive"]
OFFICIAL_SOURCE = ["official_database", "official_documentation"]
VISIT_STATUS = ["entered_database", "confirmed_dead", "restricted", "manual_blocked"]
FORBIDDEN_MISSING = ["none", "unclear", "n/a", "na", "not specified"]
FORBIDDEN_ASSOCIATION = ["yes", "no", "true", "false", "unclear"]
PLACEHOLDER_TERMS = [
    "multiple species", "various species", "many species", "several species", "diverse species", "multiple organisms", "various organisms", "multiple tissues", "various tissues",
    "many tissues", "several tissues", "multiple organs", "various organs", "multiple brain regions", "various brain regions", "multiple cell types", "various cell types",
    "many cell types", "several cell types", "multiple diseases", "various diseases", "multiple stages", "various stages", "multiple visualizations", "various visualizations", "various plots",
]
NEURAL_TERMS = ["brain", "neural", "neuron", "glia", "cortex", "hippocamp", "cerebell", "spinal", "astrocy", "microglia", "oligodend", "parkinson", "alzheimer"]
REASON_CHARS, STATEMENT_CHARS = 80, (20, 300)
# Columns of the statistics table, its first year and its vocabularies.
LANDSCAPE_COLUMNS = ["id", "name", "year", "accessibility", "species", "disease", "development", "region", "resolution", "read", "classification"]
LANDSCAPE_FIRST = 1800
LANDSCAPE_TAGS = {"resolution": ["bulk", "single_cell"], "read": ["short", "long"]}
LANDSCAPE_ACCESS = ["yes", "no", "live", "dead"]
# Columns by their bare names, and the values that they may hold as a whole.
ALLOWED = {
    "original48": ["yes", "no"],
    "accessibility": ["live", "dead"],
    "db_type_confirmation": ["yes", "no"],
    "exclusion_code": EXCLUSION_CODE,
    "evidence_source_type": EVIDENCE_SOURCE,
    "manual_review_needed": ["yes", "no"],
    "neural_link": ["primary", "partial", "none"],
    "focus": ["as_focused", "transcriptomics_general", "unknown"],
    "gene_expression_available": ["yes", "no"],
    "sequencing_resolution": ["bulk", "single_cell", "bulk;single_cell"],
    "read_technology": ["short", "long", "long;short"],
}
ASSOCIATIONS = ["disease_association", "developmental_association"]
PLACEHOLDER_COLUMNS = ["species", "disease_association", "developmental_association", "tissue_or_brain_region", "cell_type", "visualization_methods"]
UNKNOWN_COLUMNS = ["focus", *PLACEHOLDER_COLUMNS]
REQUIRED = [
    "accessibility", "db_type_confirmation", "confirmation_reason", "qualification_basis", "exclusion_code", "evidence_url", "evidence_source_type", "evidence_statement",
    "evidence_checked_date", "manual_review_needed", "neural_link", "focus", "gene_expression_available", "species", "disease_association", "developmental_association",
    "tissue_or_brain_region", "cell_type", "sequencing_resolution", "read_technology", "visualization_methods",
]

Rule = tuple[str, str, Column, Column]  # column, rule, whether it is broken, the value to show


def low(name: str) -> Column:
    return F.lower(X.clean_chunk(F.col(name)))


def violations(df: DataFrame, pos: str, row_id: str, rules: list[Rule]) -> DataFrame:
    """``row_pos, id, column, rule, rule_no, value``: one row for each broken rule, from one pass over the table."""
    if not rules:
        return df.select(F.col(pos).alias("row_pos"), F.col(row_id).cast("string").alias("id")).limit(0).selectExpr("*", "'' AS column", "'' AS rule", "0 AS rule_no", "'' AS value")
    found = [F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(i).alias("rule_no"), F.lit(c).alias("column"), F.lit(r).alias("rule"), X.clean(v).alias("value"))) for i, (c, r, broken, v) in enumerate(rules)]
    # a projection of its own: it cleans a cell once for all of its rules, which a generator's argument does not
    judged = df.select(F.col(pos).alias("row_pos"), F.col(row_id).cast("string").alias("id"), F.array(*found).alias("found"))
    each = judged.select("row_pos", "id", F.explode(F.filter("found", lambda x: x.isNotNull())).alias("v"))
    return each.select("row_pos", "id", "v.column", "v.rule", "v.rule_no", "v.value")


def id_violations(df: DataFrame, pos: str, row_id: str) -> DataFrame:
    """Blank ids, and ids that an earlier row has, with where it stands as a sheet numbers rows; in the form of ``violations``, before
    all rules of cells."""
    own = df.select(F.col(pos).alias("row_pos"), X.clean(F.col(row_id)).alias("id"))
    blank = own.filter("id = ''").select("row_pos", "id", F.lit("is blank").alias("rule"))
    some = own.filter("id <> ''")
    firsts = some.groupBy("id").agg(F.min("row_pos").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = some.join(firsts, "id").filter("row_pos > first").select("row_pos", "id", F.concat(F.lit("is a duplicate; first seen at Excel row "), F.col("first") + 2).alias("rule"))
    return blank.union(again).select("row_pos", "id", F.lit(row_id).alias("column"), "rule", F.lit(-1).alias("rule_no"), F.col("id").alias("value"))


def first_messages(found: DataFrame, most: int, spreadsheet: bool = False) -> str | None:
    """The first violations in row order as one text, and how many more there are; null if there are none. ``spreadsheet``: rows are
    named as a sheet numbers them, from 2 on."""
    rows = found.orderBy(F.col("rule_no") >= 0, "row_pos", "rule_no").limit(most + 1).collect()  # ids first
    if not rows:
        return None
    where = lambda r: f"Excel row {r.row_pos + 2}, id={r.id}" if spreadsheet else f"id {r.id}"
    text = "; ".join(f"{where(r)}: {r.column} {r.rule}: {r.value or '<blank>'}" for r in rows[:most])
    more = found.count() - most if len(rows) > most else 0
    return f"{text}; ... {more} more" if more > 0 else text


def first_failing_rule(found: DataFrame) -> DataFrame:
    """The violations of the first rule that any row breaks: later rules are not reported."""
    return found.join(F.broadcast(found.agg(F.min("rule_no").alias("rule_no"))), "rule_no", "left_semi")


def required_rules(columns: list[str]) -> list[Rule]:
    return [(c, "is blank", X.clean_chunk(F.col(c)) == "", F.col(c)) for c in columns]


def allowed_rules(allowed: dict[str, list[str]]) -> list[Rule]:
    return [(c, "has invalid values", ~low(c).isin(values), F.col(c)) for c, values in allowed.items()]


def forbidden_rules(columns: list[str], forbidden: list[str]) -> list[Rule]:
    """The whole cell, or any part of it, is forbidden."""
    return [(c, "has forbidden values", low(c).isin(forbidden) | F.exists(tags.split_tags(low(c)), lambda t: t.isin(forbidden)), F.col(c)) for c in columns]


def placeholder_rules(columns: list[str], terms: list[str] = PLACEHOLDER_TERMS) -> list[Rule]:
    return [(c, "has placeholder terms", reduce(lambda a, b: a | b, [low(c).contains(t) for t in terms]), F.col(c)) for c in columns]


def length_rule(column: str, least: int, most: int) -> Rule:
    return (column, f"must have {least}-{most} characters", ~F.length(X.clean_chunk(F.col(column))).between(least, most), F.col(column))


def basis_rule(column: str = "qualification_basis") -> Rule:
    parts = tags.split_tags(low(column))
    bad = (F.size(parts) == 0) | (F.size(F.array_distinct(parts)) < F.size(parts)) | (F.size(F.array_except(parts, F.array(*map(F.lit, [*QUALIFICATION_BASIS, "not_applicable"])))) > 0)
    return (column, "has invalid values", bad | F.array_contains(parts, "not_applicable") & (F.size(parts) > 1), F.col(column))


def is_http_url(c: Column) -> Column:
    return c.rlike(r"(?iU)^https?://\S+$")


def is_iso_date(c: Column) -> Column:
    """Four, two and two digits, and a day that there is."""
    return c.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).isNotNull()


def evidence_rules(url: str = "evidence_url", statement: str = "evidence_statement", date: str = "evidence_checked_date") -> list[Rule]:
    return [
        (url, "invalid evidence URL", ~is_http_url(X.clean_chunk(F.col(url))), F.col(url)),
        length_rule(statement, *STATEMENT_CHARS),
        (date, "invalid evidence date", ~is_iso_date(X.clean_chunk(F.col(date))), F.col(date)),
    ]


def decision_rules() -> list[Rule]:
    """Fields that must agree with a yes, and with a no."""
    basis = F.array_distinct(tags.split_tags(low("qualification_basis")))
    direct = F.arrays_overlap(basis, F.array(*map(F.lit, DIRECT_SPLICING)))
    focus = F.when(direct, F.lit("as_focused")).otherwise(F.lit("transcriptomics_general"))
    only_na = (F.size(basis) == 1) & F.array_contains(basis, "not_applicable")
    yes = only_na | (low("exclusion_code") != "not_applicable") | (low("focus") != focus) | (low("manual_review_needed") != "no")
    no = ~only_na | (low("exclusion_code") == "not_applicable") | (low("focus") != "unknown") | (low("gene_expression_available") != "no")
    no = no | (low("manual_review_needed") == "yes") & (low("exclusion_code") != "insufficient_evidence")
    decision = low("db_type_confirmation")
    return [("db_type_confirmation", "inconsistent yes decision", (decision == "yes") & yes, F.col("id")), ("db_type_confirmation", "inconsistent no decision", (decision == "no") & no, F.col("id"))]


def final_evidence_rules() -> list[Rule]:
    access, source = F.lower(X.clean(F.col("accessibility"))), F.lower(X.clean(F.col("evidence_source_type")))
    return [
        ("evidence_url", "invalid evidence URL", ~is_http_url(X.clean(F.col("evidence_url"))), F.col("evidence_url")),
        ("evidence_source_type", "live evidence must be official", (access == "live") & ~source.isin(OFFICIAL_SOURCE), source),
        ("evidence_source_type", "dead evidence must be publication", (access == "dead") & (source != "publication"), source),
        ("accessibility", "invalid accessibility", ~access.isin("live", "dead"), access),
    ]


def final_decision_rules(neural_columns: list[str]) -> list[Rule]:
    c = lambda n: F.lower(X.clean(F.col(n)))
    decision, basis, exclusion, manual = c("db_type_confirmation"), c("qualification_basis"), c("exclusion_code"), c("manual_review_needed")
    yes, no = decision == "yes", decision == "no"
    return [
        ("qualification_basis", "yes requires a basis", yes & basis.isin("", "not_applicable"), basis),
        ("exclusion_code", "yes excludes nothing and needs no review", yes & ((exclusion != "not_applicable") | (manual != "no")), exclusion),
        ("exclusion_code", "no requires an exclusion code and no basis", no & ((basis != "not_applicable") | exclusion.isin("", "not_applicable")), exclusion),
        ("focus", "no requires unknown focus and no expression", no & ((c("focus") != "unknown") | (c("gene_expression_available") != "no")), c("focus")),
        ("db_type_confirmation", "invalid decision", ~decision.isin("yes", "no"), decision),
        ("manual_review_needed", "review only with insufficient evidence", (manual == "yes") & ~(no & (exclusion == "insufficient_evidence")), manual),
        ("manual_review_needed", "invalid value", ~manual.isin("yes", "no"), manual),
        ("evidence_statement", "must have 20-300 characters", ~F.length(X.clean(F.col("evidence_statement"))).between(*STATEMENT_CHARS), F.col("evidence_statement")),
        ("evidence_checked_date", "invalid date", ~X.clean(F.col("evidence_checked_date")).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("evidence_checked_date")),
        ("neural_link", "none conflicts with neural metadata", (c("neural_link") == "none") & has_neural_metadata(neural_columns), c("neural_link")),
    ]


def has_neural_metadata(columns: list[str]) -> Column:
    """Whether the columns speak of the nervous system; a kidney's cortex does not."""
    text = F.regexp_replace(F.concat_ws(";", *[X.clean(F.col(c)) for c in columns]), r"(?i)\b(?:renal|kidney)\s+cortex\b", "")
    return text.rlike("(?i)" + "|".join(NEURAL_TERMS))


def consistent_neural_link(df: DataFrame, columns: list[str], name: str = "neural_link") -> DataFrame:
    """A link of none becomes partial where the metadata says otherwise."""
    wrong = (F.lower(X.clean(F.col(name))) == "none") & has_neural_metadata(columns)
    return df.withColumn(name, F.when(wrong, F.lit("partial")).otherwise(F.col(name)))


def chunk_review_limit(n: int) -> int:
    """Rows of a chunk that may be left to manual review: a twentieth, rounded down."""
    return int(n * 0.05)


def final_review_limit(n: int) -> int:
    """The same at the end: a twentieth, rounded up, one at least; none of no rows."""
    return max(1, math.ceil(n / 20)) if n else 0


def chunk_review_limits(n: Column) -> Column:
    """``chunk_review_limit`` of a column of counts."""
    return F.floor(n * 0.05)


def final_review_limits(n: Column) -> Column:
    """``final_review_limit`` of a column of counts."""
    return F.when(n > 0, F.greatest(F.lit(1).cast("long"), F.ceil(n / 20))).otherwise(F.lit(0).cast("long"))


def curation_rules() -> list[Rule]:
    """All rules of a curated chunk, in the order in which they are judged."""
    return [
        *required_rules(REQUIRED),
        length_rule("confirmation_reason", 1, REASON_CHARS),
        *allowed_rules(ALLOWED),
        *forbidden_rules(ASSOCIATIONS, FORBIDDEN_ASSOCIATION),
        *forbidden_rules(UNKNOWN_COLUMNS, FORBIDDEN_MISSING),
        *placeholder_rules(PLACEHOLDER_COLUMNS),
        basis_rule(),
        *evidence_rules(),
        *decision_rules(),
    ]


def validate_chunk(result: DataFrame | None, source: DataFrame, pos: str, columns: list[str], frozen: list[str]) -> dict:
    """Status of a curated chunk against its input: ``pending`` without a result, ``complete``, or ``invalid`` with the first failing
    rule's first violations. Checks in order: the input's columns, the result's columns and their order, row count, order of ids,
    unchanged cells, the rules, the share of manual reviews."""
    from .link import changed_rows

    if result is None:
        return {"status": "pending", "input_rows": None, "result_rows": None, "error": "result is missing"}
    n_in, n_out = source.count(), result.count()
    report = lambda error: {"status": "invalid" if error else "complete", "input_rows": n_in, "result_rows": n_out, "error": error or ""}
    if [c for c in source.columns if c != pos] != columns:
        return report("the input's columns are not those of a curation table")
    missing = [c for c in columns if c not in result.columns]
    if missing:
        return report(f"missing columns: {', '.join(missing)}")
    extra = [c for c in result.columns if c not in columns and c != pos]
    if extra:
        return report(f"unknown columns: {', '.join(extra)}")
    if [c for c in result.columns if c != pos] != columns:
        return report("columns are in another order")
    if n_in != n_out:
        return report(f"expected {n_in} rows, found {n_out}")
    if not changed_rows(source, result, pos, ["id"]).isEmpty():
        return report("ids are in another order")
    changed = changed_rows(source, result, pos, frozen).orderBy(pos).limit(5).collect()
    if changed:
        return report("; ".join(f"{r.column} changed: {r.was or '<blank>'} to {r.now or '<blank>'}" for r in changed))
    error = first_messages(first_failing_rule(violations(result, pos, "id", curation_rules())), 5)
    if error:
        return report(error)
    reviews = result.filter(low("manual_review_needed") == "yes").count()
    if reviews > chunk_review_limit(n_out):
        return report(f"manual review limit exceeded: {reviews}/{n_out} rows, maximum {chunk_review_limit(n_out)}")
    return report(None)


def loader_rules(kinds: dict[str, str]) -> list[Rule]:
    """Rules of a catalog's typed columns (``kinds``: column to type)."""
    rules: list[Rule] = []
    for c, kind in kinds.items():
        text, value = X.clean(F.col(c)), F.col(c)
        some = ~X.is_blank(value)
        if kind == "t-word-url":
            rules.append((c, "invalid URL", some & ~text.rlike(r"(?iU)^https?://[^/\s?#]+\S*$"), value))
        elif kind == "t-word-doi":
            rules.append((c, "invalid DOI", some & F.exists(tags.split_tags(value), lambda d: ~ids.is_doi(d)), value))
        elif kind in ("t-numeric", "t-numeric-cite"):
            rules.append((c, "not a number", some & text.try_cast("double").isNull(), value))
        elif kind in ("t-bool", "t-bool-access"):
            rules.append((c, "not a boolean", some & X.flag(value).isNull(), value))
        elif kind == "t-word-tag":
            rules.append((c, "forbidden separator", text.rlike("[,；|]"), value))
    return rules


def visit_rules() -> list[Rule]:
    """Rules of a final review: the canonical row is a member, the visit agrees with access and decision, the statement says something."""
    c = lambda n: F.lower(X.clean(F.col(n)))
    text = lambda n: X.clean(F.col(n))
    members = F.transform(tags.split_tags(F.col("members")), X.clean_id)
    live, dead, yes = c("accessibility") == "live", c("accessibility") == "dead", c("db_type_confirmation") == "yes"
    visit, asked = c("visit_status"), c("automatic_status") == "continue_required"
    return [
        ("representative", "the representative has to be a member and the canonical name given", (text("canonical") == "") | ~F.array_contains(members, X.clean_id(F.col("representative"))), F.col("representative")),
        ("visit_status", "invalid visit status", ~visit.isin(VISIT_STATUS), visit),
        ("checked_url", "live row lacks a checked URL", live & ~is_http_url(text("checked_url")), F.col("checked_url")),
        ("click_path", "continue-required row lacks a click path", asked & (text("click_path") == ""), F.col("click_path")),
        ("visit_status", "a live resource decided yes has to be entered", yes & live & ~visit.isin("entered_database", "restricted"), visit),
        ("visit_status", "a resource behind a continue page has to be entered", yes & live & asked & (visit != "entered_database"), visit),
        ("visit_status", "a dead resource decided yes has to be confirmed dead", yes & dead & (visit != "confirmed_dead"), visit),
        ("review_statement", "review statement too short", F.length(text("review_statement")) < STATEMENT_CHARS[0], F.col("review_statement")),
    ]


def validate_final_review(result: DataFrame | None, source: DataFrame, pos: str, columns: list[str], frozen: list[str], neural_columns: list[str]) -> dict:
    """Status of a final review against its input. Checks in order: columns, row count, order of ids, unchanged cells, evidence,
    decisions with the share of manual reviews, visits."""
    from .link import changed_rows

    if result is None:
        return {"status": "pending", "input_rows": None, "result_rows": None, "error": "result is missing"}
    n_in, n_out = source.count(), result.count()
    report = lambda error: {"status": "invalid" if error else "complete", "input_rows": n_in, "result_rows": n_out, "error": error or ""}
    if any([c for c in df.columns if c != pos] != columns for df in (source, result)):
        return report("schema mismatch")
    if n_in != n_out:
        return report("row count mismatch")
    if not changed_rows(source, result, pos, ["id"]).isEmpty():
        return report("id order mismatch")
    changed = changed_rows(source, result, pos, frozen).orderBy(pos).limit(1).collect()
    if changed:
        return report(f"immutable column was changed: {changed[0].column}")
    for rules in (final_evidence_rules(), final_decision_rules(neural_columns)):
        error = first_messages(violations(result, pos, "id", rules), 8)
        if error:
            return report(error)
    reviews = result.filter(F.lower(X.clean(F.col("manual_review_needed"))) == "yes").count()
    if reviews > final_review_limit(n_out):
        return report(f"manual review limit exceeded: {reviews}/{n_out} rows, maximum {final_review_limit(n_out)}")
    return report(first_messages(violations(result, pos, "id", visit_rules()), 8))


def review_manifest(spark, chunks: dict[str, tuple[DataFrame, DataFrame | None]], earlier: DataFrame | None, policy: str, check) -> DataFrame:
    """``chunk_id, status, input_rows, result_rows, error, policy_version`` of every chunk (id to input and result), as ``check(result,
    source)`` says. An earlier manifest of another policy version is an error."""
    if earlier is not None:
        other = policy_mismatches(earlier.filter(X.clean(F.col("policy_version")) != ""), "policy_version", policy)
        if other:
            raise ValueError(f"policy version is {', '.join(other)} in the manifest, not {policy}")
    said = {k: check(result, source) for k, (source, result) in sorted(chunks.items())}
    rows = [(k, *(v[c] for c in ("status", "input_rows", "result_rows", "error")), policy) for k, v in said.items()]
    return spark.createDataFrame(rows, "chunk_id string, status string, input_rows long, result_rows long, error string, policy_version string")


def landscape_rules(this_year: int) -> list[Rule]:
    """Rules of a statistics table's cells: years are whole and within range, tags and accessibility within their vocabularies."""
    year = F.col("year").cast("string").try_cast("double")
    outside = lambda c, allowed: F.size(F.array_except(F.transform(tags.split_tags(F.col(c)), lambda t: F.lower(X.collapse(t))), F.array(*map(F.lit, allowed)))) > 0
    access = F.lower(X.collapse(F.coalesce(F.col("accessibility").cast("string"), F.lit(""))))
    return [
        ("name", "is missing", X.is_blank(F.col("name")), F.col("name")),
        ("year", "is not a whole number", year.isNotNull() & (year != F.round(year)), F.col("year")),
        ("year", "is out of range", year.isNotNull() & ~year.between(LANDSCAPE_FIRST, this_year), F.col("year")),
        *[(c, "has unknown tags", outside(c, allowed), F.col(c)) for c, allowed in LANDSCAPE_TAGS.items()],
        ("accessibility", "has unknown values", ~access.isin(LANDSCAPE_ACCESS), F.col("accessibility")),
    ]


def landscape_violations(df: DataFrame, pos: str, this_year: int) -> DataFrame:
    """All that is wrong with a statistics table: ids and names that are missing or repeated, and its cells' rules."""
    names = id_violations(df.select(pos, "name"), pos, "name").filter("rule <> 'is blank'")
    return id_violations(df, pos, "id").union(names).union(violations(df, pos, "id", landscape_rules(this_year)))


def check_landscape(df: DataFrame, pos: str, this_year: int) -> DataFrame:
    """The table if it fits the contract, else an error: required columns first."""
    missing = [c for c in LANDSCAPE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    error = first_messages(landscape_violations(df, pos, this_year), 50, spreadsheet=True)
    if error:
        raise ValueError(error)
    return df


def policy_mismatches(df: DataFrame, column: str, version: str) -> list[str]:
    """Other policy versions than the run's among finished rows."""
    found = df.select(X.clean(F.col(column)).alias("v")).filter(F.col("v") != version).distinct().limit(5).collect()
    return sorted(r.v for r in found)


def totals_differ(summaries: dict[str, DataFrame], total: int) -> list[str]:
    """Exclusive breakdowns whose counts do not add up to the total."""
    return [name for name, df in summaries.items() if (df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) != total]
