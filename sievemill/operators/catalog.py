"""Typed-header catalogs: headers that carry display group and type, their contract, and the loader's normalization."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import tags
from sievemill.functions import text as X
from sievemill.sources import published as published_tables

# Positions, types, and the display contract of a catalog in order.
POSITIONS = ["main", "expand", "hidden"]
TYPES = ["t-word", "t-word-tag", "t-word-url", "t-word-doi", "t-numeric", "t-numeric-cite", "t-bool", "t-bool-access"]
MOST_ERRORS = 50


@dataclass(frozen=True)
class Field:
    """A column as its header describes it."""

    header: str
    name: str
    tags: tuple[str, ...]
    suffix_form: bool
    order_index: int

    @property
    def position(self) -> str | None:
        return next((t for t in self.tags if t in POSITIONS), None)

    @property
    def kind(self) -> str | None:
        return next((t for t in self.tags if t in TYPES), None)


def parse_header(header: str, order_index: int) -> Field:
    """``<main,t-word> name``; tags behind the name are understood, and rejected by the contract."""
    text = header.strip()
    prefix = re.fullmatch(r"<([^<>]*)>\s*(.*)", text, re.S)
    suffix = None if prefix else re.fullmatch(r"(.*?)\s*<([^<>]*)>", text, re.S)
    inner, name = (prefix[1], prefix[2]) if prefix else (suffix[2], suffix[1]) if suffix else ("", text)
    found = tuple(t.strip().lower() for t in inner.split(",") if t.strip())
    return Field(header, name.strip(), found, suffix is not None, order_index)


def schema_errors(fields: list[Field], expected: list[tuple[str, str, str]], banned: tuple[str, ...] = (), required: tuple[str, ...] = ("id",)) -> list[str]:
    """All that is wrong with the headers. ``expected``: name, position and type of the display columns in order."""
    errors, seen, hidden_before = [], {}, None
    for f in fields:
        where = f"column {f.order_index + 1} ({f.header})"
        if not re.fullmatch(r"[a-z][a-z0-9]*(_[a-z0-9]+)*", f.name):
            errors.append(f"{where}: name is not snake_case")
        if f.name in seen:
            errors.append(f"{where}: name is used before, in column {seen[f.name] + 1}")
        seen.setdefault(f.name, f.order_index)
        if f.name in banned:
            errors.append(f"{where}: column is not allowed")
        if f.suffix_form:
            errors.append(f"{where}: tags must come before the name")
        if sum(t in POSITIONS for t in f.tags) != 1:
            errors.append(f"{where}: exactly one position is needed")
        if sum(t in TYPES for t in f.tags) != 1:
            errors.append(f"{where}: exactly one type is needed")
        errors += [f"{where}: unknown tag {t}" for t in f.tags if t not in POSITIONS and t not in TYPES]
        if f.position == "hidden":
            hidden_before = f.name
        elif f.position and hidden_before:
            errors.append(f"{where}: display column after hidden column {hidden_before}")
    shown = [(f.name, f.position, f.kind) for f in fields if f.position in ("main", "expand")]
    if expected and shown != expected:
        errors.append("display columns differ from the contract")
    errors += [f"required column is missing: {r}" for r in required if r not in seen]
    return errors


def error_text(errors: list[str]) -> str:
    shown = "\n".join(errors[:MOST_ERRORS])
    return shown if len(errors) <= MOST_ERRORS else f"{shown}\n... {len(errors) - MOST_ERRORS} more"


def display_columns(df: DataFrame, fields: list[Field]) -> DataFrame:
    """The metadata table that drives searches."""
    rows = [(f.name, f.name.replace("_", " "), f.position or "main", f.order_index, f.kind == "t-numeric-cite", f.kind == "t-bool-access", f.kind or "t-word") for f in fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, display_name string, display_group string, order_index int, is_citation boolean, is_access boolean, data_type string")


def normalizer(kind: str, c: Column) -> Column:
    """How the loader writes a cell of a type."""
    if kind == "t-word-tag":
        return tags.normalize_tags(c)
    if kind == "t-word-doi":
        return tags.normalize_doi(c)
    if kind == "t-word-url":
        return tags.normalize_url(c)
    return c


def normalize(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.select(*[normalizer(kinds.get(c, ""), F.col(c)).alias(c) for c in df.columns])


def changed_cells(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """One row: for each normalized type, how many cells the loader changes; null and empty are the same."""
    sums = {}
    for c, kind in kinds.items():
        if kind in ("t-word-tag", "t-word-doi", "t-word-url"):
            old, new = F.coalesce(F.col(c).cast("string"), F.lit("")), F.coalesce(normalizer(kind, F.col(c)), F.lit(""))
            sums[kind] = sums.get(kind, F.lit(0)) + F.sum(F.when(old == new, 0).otherwise(1))
    return df.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(k.removeprefix("t-word-")) for k, v in sums.items()])


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns in their types; what is no number or no flag is null, a missing access flag is false."""
    cast = {"t-numeric": lambda c: c.cast("string").try_cast("double"), "t-numeric-cite": X.to_int, "t-bool": X.flag, "t-bool-access": lambda c: F.coalesce(c.cast("boolean"), F.lit(False))}
    own = lambda c: F.when(F.col(c).isNotNull(), X.to_int(F.col(c))) if kinds.get(c) == "t-numeric-cite" else cast.get(kinds.get(c, ""), lambda x: x)(F.col(c))
    return df.select(*[own(c).alias(c) for c in df.columns])


def load(df: DataFrame, expected: list[tuple[str, str, str]], pos: str, citations: DataFrame | None = None, accessibility: DataFrame | None = None, required: tuple[str, ...] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """A validated, normalized, enriched and typed catalog with its metadata. ``citations``: ``doi, count``; ``accessibility``:
    ``url_key, accessible``. Violations raise one error that names the first of them."""
    from sievemill.functions import urls

    from .link import max_by_lookup
    from .validate import first_messages, id_violations, loader_rules, violations

    fields = [parse_header(h, i) for i, h in enumerate(c for c in df.columns if c != pos)]
    errors = schema_errors(fields, expected, required=required)
    if errors:
        raise ValueError(error_text(errors))
    kinds = {f.name: f.kind for f in fields}
    rows = normalize(df.select(pos, *[F.col(f"`{f.header}`").alias(f.name) for f in fields]), kinds)
    found = first_messages(id_violations(rows, pos, "id").union(violations(rows, pos, "id", loader_rules(kinds))), MOST_ERRORS, spreadsheet=True)
    if found:
        raise ValueError(found)
    doi = next((c for c, k in kinds.items() if k == "t-word-doi"), None)
    cite = next((c for c, k in kinds.items() if k == "t-numeric-cite"), None)
    if citations is not None and doi and cite:
        rows = max_by_lookup(rows.drop(cite), "id", tags.split_dois(F.col(doi)), citations, "doi", "count", cite)
    url, access = (next((c for c, k in kinds.items() if k == kind), None) for kind in ("t-word-url", "t-bool-access"))
    if accessibility is not None and url and access:
        rows = rows.drop(access).withColumn("url_key", urls.url_key(F.col(url))).join(accessibility.select("url_key", F.col("accessible").alias(access)), "url_key", "left").drop("url_key")
    return typed(rows.select(pos, *[f.name for f in fields]), kinds), display_columns(df, fields)


def save(rows: DataFrame, metadata: DataFrame, table: str = "database_info", columns: str = "display_columns") -> None:
    """Replace the catalog's two tables, one after the other; ``publish`` replaces them together."""
    from sievemill.sources.files import replace_table

    replace_table(rows, table)
    replace_table(metadata, columns)


def saved(spark, table: str = "database_info", columns: str = "display_columns") -> tuple[DataFrame, DataFrame]:
    """The catalog's two tables; one that is missing is an error that names it."""
    missing = [t for t in (table, columns) if not spark.catalog.tableExists(t)]
    if missing:
        raise LookupError(f"missing tables: {', '.join(missing)}")
    return spark.table(table), spark.table(columns)


def publish(rows: DataFrame, metadata: DataFrame, folder: str) -> int:
    """Publish a catalog and its metadata together; the number of the version."""
    return published_tables.publish(rows.sparkSession, folder, {"rows": rows, "metadata": metadata})


def published(spark, folder: str, number: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The catalog and its metadata as they were published together, the last ones or those of a version."""
    tables = published_tables.pinned(spark, folder, number)
    return tables["rows"], tables["metadata"]
