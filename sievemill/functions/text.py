"""Text expressions: trimming, the missing-value regimes, identifiers and small formats. All are Column to Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each regime takes for missing, in lower case, after trimming.
MISSING_TEXT = ["", "unknown", "n/a", "na", "none", "nan", "<na>", "-"]
MISSING_RESULT = ["nan", "none"]
MISSING_CHUNK = ["nan"]
MISSING_IDENTITY = ["-", "na", "n/a", "null", "unknown"]
MISSING_URL = ["nan", "<na>", "none"]
MISSING_NAME = ["", "unknown", "none", "n/a", "na", "not available", "not applicable"]


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once. An expression that stands in several places of another is copied to each, and copies of
    copies grow without bound; a lambda's variable is not."""
    return F.get(F.transform(F.array(value), f), 0)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` knows blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def clean(c: Column) -> Column:
    """Trimmed; null is empty; words such as "none" stay."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def _less(c: Column, missing: list[str]) -> Column:
    return let(clean(c), lambda text: F.when(F.lower(text).isin(missing), F.lit("")).otherwise(text))


def is_blank(c: Column) -> Column:
    """Null or white space."""
    return clean(c) == ""


def is_missing_text(c: Column) -> Column:
    """Null, or one of the loader's missing words."""
    return F.lower(clean(c)).isin(MISSING_TEXT)


def clean_result(c: Column) -> Column:
    """Trimmed; "nan" and "none" are empty."""
    return _less(c, MISSING_RESULT)


def clean_chunk(c: Column) -> Column:
    """Trimmed; "nan" is empty, "none" stays."""
    return _less(c, MISSING_CHUNK)


def identity_value(c: Column) -> Column:
    """White space collapsed; every placeholder of identity keys is empty."""
    return let(F.regexp_replace(clean_result(c), r"(?U)\s+", " "), lambda text: F.when(F.lower(text).isin(MISSING_IDENTITY), F.lit("")).otherwise(text))


def clean_url(c: Column) -> Column:
    return _less(c, MISSING_URL)


def to_int(c: Column, default: int = 0) -> Column:
    """A number cut to an integer; anything else is the default."""
    return F.coalesce(c.cast("string").try_cast("double").try_cast("bigint"), F.lit(default).cast("bigint"))


def clean_id(c: Column) -> Column:
    """``-12.0`` as ``-12``; other values trimmed."""
    whole = lambda text: F.regexp_replace(F.regexp_replace(text, r"\.0+$", ""), r"^(-?)0+(?=\d)", "$1")
    return let(clean(c), lambda text: F.when(text.rlike(r"^-?\d+(\.0+)?$"), whole(text)).otherwise(text))


def clean_int_identifier(c: Column) -> Column:
    """Whole numbers in any spelling as digits; elsewhere a ``.0`` after digits goes."""

    def of(text: Column) -> Column:
        number = text.try_cast("double")
        whole = number.isNotNull() & (number == F.floor(number)) & (F.abs(number) < 1e18)
        return F.when(whole, number.try_cast("bigint").cast("string")).otherwise(F.regexp_replace(text, r"(\d)\.0$", "$1"))

    return let(clean_result(c), of)


def clean_year(c: Column) -> Column:
    """Digits as they count, anything else empty."""
    return let(clean_int_identifier(c), lambda text: F.when(text.rlike(r"^\d+$"), text.try_cast("bigint").cast("string")).otherwise(F.lit("")))


def drop_decimal_zero(c: Column) -> Column:
    return F.regexp_replace(clean(c), r"^(\d+)\.0$", "$1")


def normalize_title(c: Column) -> Column:
    """Lower case, white space collapsed, blanks and dots stripped."""
    return F.btrim(F.regexp_replace(F.lower(clean(c)), r"(?U)\s+", " "), F.lit(" ."))


def normalize_text_identity(c: Column) -> Column:
    return F.lower(identity_value(c))


def title_key(c: Column) -> Column:
    """The deduplication key: lower case and trimmed, inner white space kept."""
    return F.lower(clean(c))


def clean_resource_name(c: Column) -> Column:
    return clean_result(c)


def sentence_case(c: Column) -> Column:
    """Only the first character in upper case, the rest as it is."""
    return let(collapse(c), lambda text: F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30)))


def column_header(c: Column) -> Column:
    """``database_url`` as ``Database URL``."""
    words = F.transform(F.split(F.replace(c, F.lit("_"), F.lit(" ")), " "), lambda w: F.when(F.lower(w) == "url", F.lit("URL")).otherwise(F.initcap(w)))
    return F.array_join(words, " ")


def first_identity_value(*values: Column) -> Column:
    """The first value that is not missing as an identity, as it was given."""
    return F.coalesce(*[F.when(identity_value(v) != "", v.cast("string")) for v in values], F.lit(""))


def sort_id(c: Column) -> Column:
    """What ids are ordered by: numbers by value, then texts."""

    def of(text: Column) -> Column:
        number = F.when(text.rlike(r"^\d+$"), text.try_cast("decimal(38,0)"))
        return F.struct(number.isNull().alias("is_text"), number.alias("number"), text.alias("text"))

    return let(clean_id(c), of)


def ordered_ids(ids: Column) -> Column:
    """An array of ids in the order of ``sort_id``."""
    return F.transform(F.array_sort(F.transform(ids, lambda i: F.struct(sort_id(i).alias("by"), i.alias("id")))), lambda x: x.id)


def upper_sha256(c: Column) -> Column:
    return F.upper(F.sha2(c, 256))


def flag(c: Column) -> Column:
    """Yes and no words, case aside, and the numbers 1 and 0; anything else is null, never false."""
    yes, no = ("true", "t", "yes", "y"), ("false", "f", "no", "n")
    return let(F.lower(clean(c)), lambda text: F.when(text.isin(*yes) | (text.try_cast("double") == 1), True).when(text.isin(*no) | (text.try_cast("double") == 0), False))
