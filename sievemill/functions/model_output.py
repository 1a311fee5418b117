"""Parsers of model answers: JSON in a fence, in prose, or no JSON at all. All fields are read as text and cast on trial."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X

# The controlled vocabularies of the classification answer.
RESOURCE_TYPES = ["database", "atlas", "portal", "web server", "dataset", "knowledge base", "consortium resource", "software-data server", "other", "none"]
SCOPE_HINTS = ["direct_splicing", "transcript_model", "transcript_level_abundance", "needs_web_verification", "none"]
# The scope that each class implies.
CLASS_SCOPE = {1: "direct_splicing", 2: "transcript_model", 3: "transcript_level_abundance", 4: "needs_web_verification", 5: "needs_web_verification", 6: "none", 7: "none"}
# Reasons given where an answer could not be read.
REASON_TEXT = "Model returned non-JSON output; parsed answer from text."
REASON_INVALID = "Model returned invalid output; defaulted to No."
REASON_UNCLEAR = "Model returned invalid output; routed to expert model."

_CORRUPT = "_corrupt_record"


def without_fence(c: Column) -> Column:
    """What a code fence around the whole answer holds, or the answer."""
    fence = r"(?is)^```(?:json)?\s*(.*?)\s*```$"
    return X.let(X.clean(c), lambda text: F.when(text.rlike(fence), X.strip(F.regexp_extract(text, fence, 1))).otherwise(text))


def _parsed(text: Column, fields: list[str]) -> Column:
    schema = ", ".join(f"{f} string" for f in [*fields, _CORRUPT])
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"})


def json_object(c: Column, fields: list[str]) -> Column:
    """The answer's JSON object as a struct of texts: the whole answer, else from the first brace to the last; null if there is
    none."""

    def inner(text: Column) -> Column:
        start, end = F.instr(text, "{"), F.length(text) - F.instr(F.reverse(text), "}") + 1
        return F.when((start > 0) & text.contains("}") & (end > start) & ~text.startswith("["), F.substring(text, start, end - start + 1))

    def good(text: Column) -> Column:
        return F.when(text.startswith("{"), X.let(_parsed(text, fields), lambda s: F.when(s[_CORRUPT].isNull(), s)))

    return X.let(without_fence(c), lambda text: F.coalesce(good(text), X.let(inner(text), good)))


def yes_no(c: Column) -> Column:
    """Yes or No by word, else by how the letters begin; No by default."""
    letters = lambda text: F.lower(F.regexp_replace(text, "[^a-zA-Z]", ""))
    return X.let(X.clean(c), lambda text: F.when(text.rlike(r"(?i)\byes\b") | letters(text).startswith("yes"), F.lit("Yes")).otherwise(F.lit("No")))


def parse_check(c: Column) -> Column:
    """``AI_check, AI_reason`` of an answer; without a reason the text itself is judged."""
    said_no = X.clean(c).rlike(r"(?i)\bno\b")
    fallback = F.when((yes_no(c) == "No") & ~said_no, F.lit(REASON_INVALID)).otherwise(F.lit(REASON_TEXT))
    found = lambda check, reason: F.struct(check.alias("AI_check"), reason.alias("AI_reason"))
    usable = lambda data: F.when(~X.is_blank(data["AI_reason"]), found(yes_no(data["AI_check"]), X.clean(data["AI_reason"])))
    return F.coalesce(X.let(json_object(c, ["AI_check", "AI_reason"]), usable), found(yes_no(c), fallback))


def triage_decision(c: Column) -> Column:
    letters = F.lower(F.regexp_replace(X.clean(c), "[^a-zA-Z]", ""))
    return F.when(letters.startswith("reject"), F.lit("Reject")).when(letters.startswith("pass"), F.lit("Pass")).otherwise(F.lit("Unclear"))


def parse_triage(c: Column) -> Column:
    """``stage1_decision, stage1_reason``; Unclear where the answer can't be read."""
    found = lambda decision, reason: F.struct(decision.alias("stage1_decision"), reason.alias("stage1_reason"))
    usable = lambda data: F.when(~X.is_blank(data["stage1_reason"]), found(triage_decision(data["stage1_decision"]), X.clean(data["stage1_reason"])))
    return F.coalesce(X.let(json_object(c, ["stage1_decision", "stage1_reason"]), usable), found(F.lit("Unclear"), F.lit(REASON_UNCLEAR)))


def _allowed(c: Column, values: list[str], default: Column) -> Column:
    return X.let(X.clean(c), lambda v: F.when(v.isin(values), v).otherwise(default))


def parse_classification(c: Column, policy: str) -> Column:
    """Class, check derived from it, vocabulary fields and ``error``, which is null for a valid answer."""
    scopes = F.create_map(*[F.lit(v) for kv in CLASS_SCOPE.items() for v in kv])

    def number(data: Column) -> Column:
        return X.let(X.clean(data["AI_class"]), lambda v: F.when(v.rlike(r"^[+-]?\d+$"), v.try_cast("int")))

    def hint(data: Column, n: Column, scope: Column) -> Column:
        own = _allowed(data["target_scope_hint"], SCOPE_HINTS, scope)
        fifth = X.let(own, lambda h: F.when(h == "none", F.lit("needs_web_verification")).otherwise(h))
        return F.when(n.isin(1, 2, 3, 4), scope).when(n == 5, fifth).otherwise(F.lit("none"))

    def answer(data: Column, n: Column) -> Column:
        low = n.isin(6, 7)
        error = (
            F.when(data.isNull(), F.lit("Model returned no JSON object"))
            .when(n.isNull(), F.lit("Stage2 response missing valid integer AI_class"))
            .when(~n.between(1, 7), F.concat(F.lit("Stage2 response has invalid AI_class: "), n.cast("string")))
        )
        fields = {
            "AI_class": n,
            "AI_check": F.when(n <= 5, F.lit("Yes")).otherwise(F.lit("No")),
            "screening_policy_version": F.lit(policy),
            "AI_reason": X.clean(data["AI_reason"]),
            "resource_name": X.let(X.clean(data["resource_name"]), lambda v: F.when(v == "", F.lit("none")).otherwise(v)),
            "resource_type": _allowed(data["resource_type"], RESOURCE_TYPES, F.when(low, F.lit("none")).otherwise(F.lit("other"))),
            "url_mentioned": yes_no(data["url_mentioned"]),
            "target_scope_hint": hint(data, n, F.try_element_at(scopes, n)),
        }
        return F.struct(*[F.when(n.between(1, 7), v).alias(k) for k, v in fields.items()], error.alias("error"))

    found = json_object(c, ["AI_class", "AI_reason", "resource_name", "resource_type", "url_mentioned", "target_scope_hint"])
    return X.let(found, lambda data: X.let(number(data), lambda n: answer(data, n)))


def usage(c: Column, names: dict[str, str]) -> list[Column]:
    """Counts nested in a usage struct as flat columns, empty where absent. ``names``: column to path."""
    return [F.coalesce(F.get_json_object(F.to_json(c), f"$.{path}"), F.lit("")).alias(name) for name, path in names.items()]
