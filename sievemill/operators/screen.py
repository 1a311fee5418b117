"""Text screening with two lexicons, and splits by what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import text as X

# The default resource lexicon; alternatives are tried in this order.
RESOURCE_TERMS = [r"database", r"knowledge\s*base", r"knowledgebase", r"dataset", r"data\s*set", r"catalog(?:ue)?", r"biobank", r"atlas", r"portal", r"web\s*server", r"resources?"]
# The default scope lexicon; alternatives are tried in this order.
SCOPE_TERMS = [
    r"rna\w*", r"mRNA\w*", r"pre[-\s]?mRNA\w*", r"ncRNA\w*", r"lncRNA\w*", r"long\s+non[-\s]?coding\s+RNA\w*", r"miRNA\w*", r"microRNA\w*",
    r"circRNA\w*", r"circular\s+RNA\w*", r"snRNA\w*", r"snoRNA\w*", r"piRNA\w*", r"siRNA\w*", r"transcript\w*", r"transcriptome\w*", r"transcriptomic\w*",
    r"RNA[-\s]?seq", r"RNAseq", r"bulk\s+RNA", r"single[-\s]?cell\s+RNA", r"single[-\s]?nucleus\s+RNA", r"scRNA[-\s]?seq", r"snRNA[-\s]?seq",
    r"expression\s+atlas", r"gene\s+expression", r"transcript\s+expression", r"isoform\w*", r"exon\w*", r"intron\w*", r"exon[-\s]?usage", r"junction\w*",
    r"splice[-\s]?junction\w*", r"UTR\w*", r"poly\(?A\)?", r"polyadenylation", r"splic\w*", r"alternative\s+splicing", r"splice[-\s]?site\w*",
    r"splice[-\s]?variant\w*", r"spliceosome", r"exon\s+skipping", r"intron\s+retention", r"eQTL\w*", r"sQTL\w*", r"splice[-\s]?QTL\w*",
    r"splicing\s+quantitative\s+trait\s+loci", r"expression\s+quantitative\s+trait\s+loci", r"transcriptome[-\s]?wide\s+association\w*", r"cDNA", r"EST\b",
    r"expressed\s+sequence\s+tag\w*", r"gene\s+model\w*", r"reference\s+sequence\w*", r"RefSeq", r"GENCODE", r"splice[-\s]?site\s+variant\w*",
    r"synonymous\s+variant\w*", r"synonymous\s+mutation\w*", r"RNA\s+editing", r"RNA\s+modification", r"RNA\s+methylation", r"transcript\s+consequence\w*",
    r"protein\s+isoform\w*", r"proteome[-\s]?supported\s+isoform\w*",
]


def lexicon(terms: list[str]) -> str:
    """A pattern that finds any of the terms as whole words."""
    return rf"\b(?:{'|'.join(terms)})\b"


RESOURCE_PATTERN = lexicon(RESOURCE_TERMS)
SCOPE_PATTERN = lexicon(SCOPE_TERMS)


def matched_terms(text: Column, pattern: str) -> Column:
    """Distinct matches in lower case, sorted; case and words are Unicode's."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"(?iU){pattern}"), F.lit(0)), F.lower)))


def keyword_screen(df: DataFrame, pattern: str = RESOURCE_PATTERN, scope: str | None = SCOPE_PATTERN, title: str = "title", abstract: str = "abstractText") -> DataFrame:
    """Rows whose title and abstract hold a term of both lexicons, with ``matched_terms`` and ``matched_scope_terms``. Without a
    scope lexicon only the first counts and the scope terms are empty. A missing column counts as empty."""
    part = lambda name: X.clean(F.col(name)) if name in df.columns else F.lit("")
    text = X.strip(F.concat(part(title), F.lit(" "), part(abstract)))
    found = df.withColumn("matched_terms", matched_terms(text, pattern)).filter(F.size("matched_terms") > 0)
    if scope is None:
        return found.withColumn("matched_scope_terms", F.array().cast("array<string>"))
    return found.withColumn("matched_scope_terms", matched_terms(text, scope)).filter(F.size("matched_scope_terms") > 0)


def split_missing(df: DataFrame, column: str = "abstractText") -> tuple[DataFrame, DataFrame]:
    """Rows with text in the column, and rows without; without the column all are without."""
    if column not in df.columns:
        return df.limit(0), df
    has = X.clean(F.col(column)) != ""
    return df.filter(has), df.filter(~has)


def yes_only(df: DataFrame, column: str = "AI_check") -> DataFrame:
    return df.filter(F.lower(X.clean(F.col(column))) == "yes") if column in df.columns else df.limit(0)


def mark_skipped(df: DataFrame, value: str = "Skipped", rows: int | None = None) -> DataFrame:
    marked = df.withColumn("AI_check", F.lit(value))
    return marked if rows is None else marked.limit(rows)
