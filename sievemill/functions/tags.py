"""Multi-valued cells: ``a;b;c`` as arrays and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ids
from . import text as X


def split_tags(c: Column) -> Column:
    """Trimmed parts of a cell, empty ones dropped; null has none."""
    parts = F.transform(F.split(F.coalesce(c.cast("string"), F.lit("")), ";"), X.strip)
    return F.filter(parts, lambda p: p != "")


def distinct_ignoring_case(tags: Column) -> Column:
    """The first spelling of each tag, in order."""
    first = lambda own: X.let(F.transform(own, F.lower), lambda low: F.filter(own, lambda t, i: F.array_position(low, F.lower(t)) == i + 1))
    return X.let(tags, first)


def normalize_tags(c: Column) -> Column:
    """A cell with each tag once, in its first spelling; null without one."""
    return X.let(distinct_ignoring_case(split_tags(c)), lambda tags: F.when(F.size(tags) > 0, F.array_join(tags, ";")))


def split_dois(c: Column) -> Column:
    """DOIs of a cell without prefixes, each once."""
    parts = F.filter(F.transform(split_tags(c), ids.doi_token), lambda d: d != "")
    return distinct_ignoring_case(parts)


def normalize_doi(c: Column) -> Column:
    return X.let(split_dois(c), lambda found: F.when(F.size(found) > 0, F.array_join(found, ";")))


def normalize_url(c: Column) -> Column:
    return F.when(~X.is_missing_text(c), X.clean(c))


def has_tag(c: Column, tag: str) -> Column:
    """Whether a cell holds a tag, spaces and case aside; a null cell does not."""
    return F.exists(split_tags(c), lambda t: F.lower(t) == tag.strip().lower())


def outside(tokens: Column, allowed: list[str]) -> Column:
    """Tokens that a vocabulary does not hold."""
    return F.array_except(F.transform(tokens, F.lower), F.array(*map(F.lit, allowed)))


def set_key(tags: Column) -> Column:
    """One text for a set of tags, whatever their order and case."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(tags, F.lower))), ";")


def doi_links(c: Column) -> Column:
    """Addresses of a DOI cell's parts; parts that are addresses stay."""
    return F.transform(split_tags(c), lambda d: F.when(d.rlike("(?i)^https?://"), d).otherwise(F.concat(F.lit("https://doi.org/"), d)))
