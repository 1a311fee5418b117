"""Web addresses: keys, candidates, extraction and page status, from pieces that regular expressions cut out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X

# What ends an address in prose, what an address looks like there, and addresses of papers.
TRAILING = ".,;:)]}>\"'"
IN_TEXT = r"(?i)\b(?:https?://|www\.)[^\s<>\"]+"
PUBLICATION = ["doi.org/", "europepmc.org/", "pubmed.ncbi.nlm.nih.gov/", "ncbi.nlm.nih.gov/pubmed"]
# Page texts that stand in the way, and the statuses they mean.
RESTRICTED_CODES = [401, 403, 429]
CONTINUE = [
    r">\s*(?:continue(?:\s+(?:anyway|to(?:\s+the)?\s+site))?|proceed(?:\s+anyway)?|enter(?:\s+the)?\s+site|i\s+understand)\s*<",
    r">\s*(?:继续访问|继续前往|进入网站|我已了解)\s*<",
]
RESTRICTED = [
    r"captcha",
    r"verify\s+(?:that\s+)?you\s+are\s+(?:a\s+)?human",
    r"checking\s+your\s+browser",
    r"attention\s+required[^<]{0,80}cloudflare",
    r"buy\s+(?:this|the)\s+domain",
    r"domain\s+(?:name\s+)?(?:is\s+)?(?:for\s+sale|parked)",
    r"(?:sedo|afternic|hugedomains)\s+(?:domain\s+)?(?:parking|marketplace)",
]
BODY_BYTES = 262_144

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def with_scheme(c: Column) -> Column:
    return X.let(c, lambda u: F.when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u)))


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))


def _host_port(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(url, _AUTHORITY, 1), r"^.*@", "")


def full_host(url: Column) -> Column:
    return F.lower(F.regexp_replace(_host_port(url), r":\d*$", ""))


def host(url: Column) -> Column:
    """Host in lower case, less ``www.``"""
    return F.regexp_replace(full_host(with_scheme(X.clean(url))), r"^www\.", "")


def port(url: Column) -> Column:
    return F.regexp_extract(_host_port(url), r":(\d+)$", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*[?]([^#]*)", 1)


def _joined(where: Column, p: Column, q: Column) -> Column:
    return F.concat(F.lit("//"), where, p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))


def _short_path(p: Column) -> Column:
    return F.when(p.isin("", "/"), F.lit("/")).otherwise(F.rtrim(p, F.lit("/")))


def _bare_host(url: Column) -> Column:
    return F.regexp_replace(full_host(url), r"^www\.", "")


def database_url_key(c: Column) -> Column:
    """``//host/path?query`` without scheme, ``www.``, port, fragment, doubled or closing slashes; placeholders are empty."""

    def of(url: Column) -> Column:
        p = X.let(F.regexp_replace(path(url), "/+", "/"), _short_path)
        return X.let(_bare_host(url), lambda h: F.when(h == "", F.lit("")).otherwise(_joined(h, p, query(url))))

    return X.let(X.clean(c), lambda text: F.when(F.lower(text).isin(X.MISSING_NAME), F.lit("")).otherwise(X.let(with_scheme(text), of)))


def url_key(c: Column) -> Column:
    """The key of liveness checks: like ``database_url_key``, but other ports than the scheme's stay and inner slashes too."""

    def where(url: Column, h: Column) -> Column:
        usual = lambda own: (own == "") | (scheme(url) == "http") & (own == "80") | (scheme(url) == "https") & (own == "443")
        return X.let(port(url), lambda own: F.when(usual(own), h).otherwise(F.concat_ws(":", h, own)))

    def of(url: Column, text: Column) -> Column:
        return X.let(_bare_host(url), lambda h: F.when(h == "", F.lower(text)).otherwise(_joined(where(url, h), X.let(path(url), _short_path), query(url))))

    return X.let(X.clean_url(c), lambda text: F.when(text == "", F.lit("")).otherwise(X.let(with_scheme(text), lambda url: of(url, text))))


def url_candidates(c: Column) -> Column:
    """Up to four spellings: given and other scheme, each with host as given and with ``www.`` put on or off."""
    none = F.array().cast("array<string>")

    def spelled(url: Column, w: Column) -> Column:
        rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*", "")
        toggled = F.when(F.lower(w).startswith("www."), F.substring(w, 5, 1 << 30)).otherwise(F.concat(F.lit("www."), w))
        first = scheme(url)
        other = F.when(first == "https", F.lit("http")).otherwise(F.lit("https"))
        made = F.array_distinct(F.array(*[F.concat(s, F.lit("://"), h, rest) for s in (first, other) for h in (w, toggled)]))
        return F.when(w == "", none).otherwise(made)

    def of(text: Column) -> Column:
        url = F.regexp_replace(with_scheme(text), r"#.*$", "")
        return F.when(text == "", none).otherwise(X.let(url, lambda u: X.let(F.regexp_extract(u, _AUTHORITY, 1), lambda w: spelled(u, w))))

    return X.let(X.clean_url(c), of)


def trimmed_url(c: Column) -> Column:
    """An address found in prose, less closing punctuation; ``www.`` gets a scheme."""
    return X.let(F.rtrim(X.strip(c), F.lit(TRAILING)), lambda u: F.when(F.lower(u).startswith("www."), F.concat(F.lit("https://"), u)).otherwise(u))


def is_publication_url(c: Column) -> Column:
    low = F.lower(c)
    return reduce(lambda a, b: a | b, [low.contains(p) for p in PUBLICATION])


def first_database_url(*texts: Column) -> Column:
    """The first address of the texts, in their order, that is not a paper's; empty without one."""
    found = F.flatten(F.array(*[F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(IN_TEXT), F.lit(0)) for t in texts]))
    good = F.filter(F.transform(found, trimmed_url), lambda u: (u != "") & ~is_publication_url(u))
    return F.coalesce(F.get(good, 0), F.lit(""))


def body(c: Column) -> Column:
    """The part of a page that is looked at."""
    return F.substring(F.coalesce(c, F.lit("")), 1, BODY_BYTES)


def page_status(code: Column, page: Column) -> Column:
    """Refusing codes first, then pages to click through, then captchas and parked domains, then the code."""
    text = body(page)
    hit = lambda patterns: text.rlike("(?iU)" + "|".join(f"(?:{p})" for p in patterns))
    return (
        F.when(code.isin(RESTRICTED_CODES), F.lit("restricted"))
        .when(hit(CONTINUE), F.lit("continue_required"))
        .when(hit(RESTRICTED), F.lit("restricted"))
        .when(code < 400, F.lit("reachable"))
        .otherwise(F.lit("unreachable"))
    )


def accessible(status: Column) -> Column:
    """Null for a missing address, true where something answers."""
    return F.when(status == "missing", F.lit(None).cast("boolean")).otherwise(status.isin("reachable", "restricted", "continue_required"))
