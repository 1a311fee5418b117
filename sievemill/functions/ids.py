"""Identifiers of papers: the five DOI normal forms, which differ on purpose, and identity keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X

# Prefixes that DOI spellings carry.
DOI_URL = r"(?i)^https?://(dx\.)?doi\.org/"
DOI_WORD = r"(?i)^doi:\s*"
DOI_PATTERN = r"(?i)^10\.\d{4,9}/\S+$"


def doi_token(c: Column) -> Column:
    """Loader form: the word, then the address goes; case stays; missing words are empty."""
    text = F.regexp_replace(F.regexp_replace(X.clean(c), DOI_WORD, ""), DOI_URL, "")
    return F.when(X.is_missing_text(c), F.lit("")).otherwise(X.strip(text))


def doi_matching(c: Column) -> Column:
    """Benchmark form: lower case; the address, then the word goes."""
    return X.strip(F.regexp_replace(F.regexp_replace(F.lower(X.clean(c)), DOI_URL, ""), DOI_WORD, ""))


def doi_identity(c: Column) -> Column:
    """Identity form: placeholders are empty; address and word go, closing dots too; lower case."""
    text = F.regexp_replace(F.regexp_replace(X.identity_value(c), DOI_URL, ""), DOI_WORD, "")
    return F.lower(F.rtrim(X.strip(text), F.lit(".")))


def doi_bare(c: Column) -> Column:
    """Curation form: only ``http(s)://doi.org/`` goes, case stays."""
    return F.regexp_replace(X.clean_result(c), r"(?i)^https?://doi\.org/", "")


def doi_key(c: Column) -> Column:
    """Deduplication form: trimmed and in lower case, addresses kept."""
    return F.lower(X.clean(c))


def is_doi(c: Column) -> Column:
    return c.rlike(DOI_PATTERN)


def web_from_doi(c: Column) -> tuple[Column, Column]:
    """The DOI without its address (in lower-case spelling), and the address made of it."""
    doi = F.regexp_replace(X.clean(c), r"^https?://(dx\.)?doi\.org/", "")
    return doi, F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)).otherwise(F.lit(""))


def _tagged(tag: str, value: Column) -> Column:
    return X.let(value, lambda v: F.when(v != "", F.concat(F.lit(f"{tag}:"), v)))


def paper_key(row: Column, doi: Column, pmid: Column, pmcid: Column, title: Column) -> Column:
    """``doi:``, ``pmid:``, ``pmcid:`` or ``title:`` with the first value there is, or ``row:`` with the row's number."""
    plain = lambda c: F.lower(X.clean(c))
    return F.coalesce(_tagged("doi", plain(doi)), _tagged("pmid", plain(pmid)), _tagged("pmcid", plain(pmcid)), _tagged("title", plain(title)), F.concat(F.lit("row:"), row.cast("string")))


def dedup_key(doi: Column, pmid: Column, pmcid: Column, title: Column) -> Column:
    """The detail key: DOI, PMID, PMCID, then title; empty without any."""
    pairs = (("doi", doi_key(doi)), ("pmid", X.clean(pmid)), ("pmcid", F.lower(X.clean(pmcid))), ("title", X.title_key(title)))
    return F.coalesce(*[_tagged(tag, value) for tag, value in pairs], F.lit(""))


def identity_key(doi: Column, pmid: Column, pmcid: Column, title: Column, resource: Column | None = None) -> Column:
    """Identity across sources: DOI, PMID, PMCID, title and, if given, the resource's name; empty without any."""
    parts = [
        _tagged("doi", doi_identity(doi)),
        _tagged("pmid", X.clean_int_identifier(X.identity_value(pmid))),
        _tagged("pmcid", F.lower(X.identity_value(pmcid))),
        _tagged("title", X.normalize_text_identity(title)),
    ]
    if resource is not None:
        parts.append(_tagged("name", X.normalize_text_identity(resource)))
    return F.coalesce(*parts, F.lit(""))


def detail_key(source: Column, ident: Column) -> Column:
    return F.concat_ws("/", X.clean(source), X.clean(ident))


def article_detail_key(source: Column, ident: Column, pmid: Column, pmcid: Column) -> Column:
    """``source/id``; without an id the PMID of MED or the PMCID of PMC stands in."""
    own = F.when(~X.is_blank(ident), X.clean(ident)).when(X.clean(source) == "MED", X.clean(pmid)).when(X.clean(source) == "PMC", X.clean(pmcid)).otherwise(F.lit(""))
    return detail_key(source, own)
