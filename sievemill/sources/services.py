"""Outside services behind a transport: a picklable callable that takes a request and gives an answer. Executors call it in
``mapInPandas``, where no built-in operator can. Results are written before they are used twice, so that a lost executor
doesn't repeat calls."""

from __future__ import annotations

import json
import re
import ssl
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from functools import partial
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.functions import text as X

from .shared_tables import written

Transport = Callable[[dict[str, Any]], dict[str, Any]]

# Limits of the services, and statuses worth another try.
PAGE_SIZE = (1, 1000)
RETRY_CODES = [429, 500, 502, 503, 504]
ATTEMPTS = 3
CITATION_BATCH = 500
ARTICLE_COLUMNS = ["title", "keywordList", "web", "pubYear", "journal", "citedByCount", "pmid", "pmcid", "source", "doi", "abstractText"]
EDGE_COLUMNS = ["seed_pmid", "ref_source", "ref_id", "ref_title", "ref_doi", "ref_pubYear"]


class RateLimit:
    """At least tasks/rate seconds between the calls of one of several tasks that run at once; the tasks' calls fall between one
    another's. No rate is no limit."""

    def __init__(self, rate: float, tasks: int = 1, clock=time.monotonic, sleep=time.sleep, task: int = 0):
        self.gap, self.clock, self.sleep = (tasks / rate if rate else 0.0), clock, sleep
        self.next = clock() + task / rate if rate else 0.0

    def wait(self) -> None:
        now = self.clock()
        if now < self.next:
            self.sleep(self.next - now)
            now = self.next
        self.next = now + self.gap


def asked(df: DataFrame, run: Callable[[RateLimit], Callable], schema: str, rate: float) -> DataFrame:
    """What ``run(gate)`` gives of the rows, written, so that a service is asked once. All tasks that share the rate run at once, in a
    barrier stage of as many tasks as there are slots at most: each has its share of the rate, whatever the number of partitions
    was. Executors that come and go rule barriers out; the tasks are as many then, too."""
    spark = df.sparkSession
    n = max(1, min(df.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism))
    fixed = spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") != "true"

    def paced(found):
        from pyspark import BarrierTaskContext, TaskContext

        if fixed:
            BarrierTaskContext.get().barrier()  # workers take their time to start, and a share of the rate is lost meanwhile
        yield from run(RateLimit(rate, n, task=TaskContext.get().partitionId()))(found)

    return written(df.repartition(n).mapInPandas(paced, schema, barrier=fixed), "answers")[0]


def with_retries(call: Callable[[], dict], attempts: int = ATTEMPTS, sleep=time.sleep, most: float = 8.0) -> dict:
    """The answer, tried again with doubling pauses after an exception or a status worth it."""
    for n in range(attempts):
        last = n == attempts - 1
        try:
            answer = call()
        except Exception:
            if last:
                raise
        else:
            if last or answer.get("status_code", 200) not in RETRY_CODES:
                return answer
        sleep(min(2.0**n, most))
    raise AssertionError("unreachable")


class JsonTransport:
    """A service that answers in JSON over HTTP. Fields of a request that the address names in braces go there; a list of ``dois`` is
    posted, the rest are query parameters. Errors of the service come back as their status."""

    def __init__(self, address: str, fixed: dict[str, str] | None = None, headers: dict[str, str] | None = None, timeout: float = 30.0):
        self.address, self.fixed, self.headers, self.timeout = address, fixed or {}, headers or {}, timeout

    def request(self, fields: dict[str, Any]) -> urllib.request.Request:
        named = set(re.findall(r"{(\w+)}", self.address))
        url = self.address.format(**{k: urllib.parse.quote(str(v), safe="") for k, v in fields.items() if k in named})
        rest = {k: v for k, v in fields.items() if k not in named}
        body = json.dumps({"ids": [f"DOI:{d}" for d in rest.pop("dois")]}).encode() if "dois" in rest else None
        query = urllib.parse.urlencode({**self.fixed, **rest})
        headers = {**self.headers, **({"Content-Type": "application/json"} if body else {})}
        return urllib.request.Request(f"{url}?{query}" if query else url, body, headers)

    def __call__(self, fields: dict[str, Any]) -> dict[str, Any]:
        try:
            with urllib.request.urlopen(self.request(fields), timeout=self.timeout) as answer:
                found = json.load(answer)
                return {**(found if isinstance(found, dict) else {"results": found}), "status_code": answer.status}
        except urllib.error.HTTPError as e:
            return {"status_code": e.code}


class PageTransport:
    """Web pages for liveness checks: status, final address, the first bytes of the body and the redirects on the way."""

    def __init__(self, most: int = 262_144):
        self.most = most

    def __call__(self, fields: dict[str, Any]) -> dict[str, Any]:
        history: list[dict] = []

        class Redirects(urllib.request.HTTPRedirectHandler):
            def redirect_request(self, req, fp, code, msg, headers, newurl):
                history.append({"url": req.full_url})
                return super().redirect_request(req, fp, code, msg, headers, newurl)

        context = ssl.create_default_context()
        if not fields.get("verify", True):
            context.check_hostname, context.verify_mode = False, ssl.CERT_NONE
        opener = urllib.request.build_opener(Redirects, urllib.request.HTTPSHandler(context=context))
        request = urllib.request.Request(fields["url"], method=fields["method"])
        try:
            answer = opener.open(request, timeout=fields["timeout"])
        except urllib.error.HTTPError as e:
            answer = e
        with answer:
            body = answer.read(self.most) if fields["method"] == "GET" else b""
            return {"status_code": answer.status, "url": answer.geturl(), "text": body.decode("utf-8", "replace"), "history": history}


# ---- searches


def year_query(query: str, year: int) -> str:
    """Windows of two years: neighbours overlap, and deduplication absorbs what comes twice."""
    return f"{query} AND PUB_YEAR:[{year - 1} TO {year}]"


def parse_years(spec: str) -> list[int]:
    """``a-b`` in either direction, or a list with commas."""
    if m := re.fullmatch(r"\s*(\d+)\s*-\s*(\d+)\s*", spec):
        a, b = int(m[1]), int(m[2])
        return list(range(a, b + 1) if a <= b else range(a, b - 1, -1))
    return [int(x) for x in spec.split(",") if x.strip()]


def pages(transport: Transport, query: str, page_size: int = 1000, most: int | None = None) -> Iterator[dict]:
    """Articles of a cursor search: ends at an empty page, without a cursor or with one that came before, or at ``most`` articles."""
    cursor, n, seen = "*", 0, {"*"}
    size = min(max(page_size, PAGE_SIZE[0]), PAGE_SIZE[1])
    while most is None or n < most:
        answer = transport({"query": query, "cursorMark": cursor, "pageSize": size})
        found = answer.get("resultList", {}).get("result", [])
        for article in found:
            if most is not None and n >= most:
                return
            n += 1
            yield article
        after = answer.get("nextCursorMark")
        if not found or not after or after in seen:
            return
        cursor = after
        seen.add(cursor)


def article_row(a: dict) -> list[str]:
    """The flat record of a nested article."""
    journal = (a.get("journalInfo") or {}).get("journal") if isinstance(a.get("journalInfo"), dict) else None
    title = journal.get("title") if isinstance(journal, dict) else None
    doi = a.get("doi") or ""
    keywords = a.get("keywordList")
    words = ";".join(keywords.get("keyword", [])) if isinstance(keywords, dict) else keywords or ""
    try:
        cited = int(float(a.get("citedByCount") or 0))
    except (TypeError, ValueError):
        cited = 0
    values = [a.get("title"), words, f"https://doi.org/{doi}" if doi else "", a.get("pubYear"), title, cited, a.get("pmid"), a.get("pmcid"), a.get("source"), doi, a.get("abstractText")]
    return ["" if v is None else str(v) for v in values]


def article_records(df: DataFrame, column: str) -> DataFrame:
    """The same of articles that are structs already, as expressions."""
    schema = "title string, journalInfo struct<journal:struct<title:string>>, citedByCount string, pmid string, pmcid string, source string, doi string, abstractText string, pubYear string, keywordList struct<keyword:array<string>>"
    a = F.from_json(column, schema)
    text = lambda c: F.coalesce(c, F.lit(""))
    web = F.when(text(a["doi"]) != "", F.concat(F.lit("https://doi.org/"), a["doi"])).otherwise(F.lit(""))
    out = {"title": text(a["title"]), "keywordList": F.array_join(F.coalesce(a["keywordList"]["keyword"], F.array().cast("array<string>")), ";"), "web": web, "pubYear": text(a["pubYear"]), "journal": text(a["journalInfo"]["journal"]["title"])}
    out |= {"citedByCount": X.to_int(a["citedByCount"]).cast("int"), **{c: text(a[c]) for c in ("pmid", "pmcid", "source", "doi", "abstractText")}}
    return df.select(*[c for c in df.columns if c != column], *[out[c].alias(c) for c in ARTICLE_COLUMNS])


def _text_schema(columns: list[str], rest: str = "") -> str:
    return rest + ", ".join(f"{c} string" for c in columns)


def search_years(spark: SparkSession, transport: Transport, query: str, years: list[int], most_per_year: int | None = None, page_size: int = 1000) -> DataFrame:
    """Articles of every year window, a window to a task, with ``pos`` in the order of windows and pages."""

    def run(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in found:
            for k, year in zip(pdf.k, pdf.year, strict=True):
                rows = [(k * 10_000_000 + i, int(year), *article_row(a)) for i, a in enumerate(pages(transport, year_query(query, int(year)), page_size, most_per_year))]
                yield pd.DataFrame(rows, columns=["pos", "year_window", *ARTICLE_COLUMNS])

    windows = spark.createDataFrame(list(enumerate(years)), "k long, year int").repartition(max(1, len(years)), "k")
    return windows.mapInPandas(run, _text_schema(ARTICLE_COLUMNS, "pos long, year_window int, "))


def fetch_references(pmids: DataFrame, transport: Transport, rate: float = 10.0) -> DataFrame:
    """Edges of what each PMID cites, page after page until one is empty; a failing PMID has one row with its ``error``."""

    def run(gate: RateLimit, found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in found:
            for pmid in pdf.pmid:
                rows, page = [], 1
                try:
                    while True:
                        gate.wait()
                        answer = with_retries(lambda p=page, m=pmid: transport({"pmid": m, "page": p}))
                        refs = answer.get("referenceList", {}).get("reference", [])
                        if not refs:
                            break
                        rows += [(pmid, *[str(r.get(k) or "") for k in ("source", "id", "title", "doi", "pubYear")], "") for r in refs]
                        page += 1
                except Exception as e:
                    rows = [(pmid, "", "", "", "", "", str(e) or type(e).__name__)]
                yield pd.DataFrame(rows, columns=[*EDGE_COLUMNS, "error"])

    return asked(pmids.select("pmid"), lambda gate: partial(run, gate), _text_schema([*EDGE_COLUMNS, "error"]), rate)


def fetch_details(targets: DataFrame, transport: Transport, batch: int = 50, rate: float = 9.0, sleep=time.sleep) -> DataFrame:
    """Details of (source, id) targets: batches of one source by one call, matched by key, and single calls for what a batch lacks.
    Calls wait for the rate, which all tasks share, and statuses worth it are tried again. A target that fails has its ``error``."""

    def key(a: dict) -> tuple[str, str]:
        source = str(a.get("source") or "")
        return source, str(a.get("id") or (a.get("pmid") if source == "MED" else a.get("pmcid") if source == "PMC" else "") or "")

    def run(gate: RateLimit, found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def ask(request: dict) -> dict:
            gate.wait()
            answer = with_retries(lambda: transport(request), 1 + (ATTEMPTS - 1) * (rate > 0), sleep)
            if answer.get("status_code", 200) >= 400:
                raise OSError(f"status {answer['status_code']}")
            return answer

        for pdf in found:
            rows = []
            for source, part in pdf.groupby("ref_source", sort=False):
                wanted = list(part.ref_id)
                for i in range(0, len(wanted), batch):
                    own, got, error = wanted[i : i + batch], {}, ""
                    try:
                        query = f"SRC:{source} AND ({' OR '.join(f'EXT_ID:{x}' for x in own)})"
                        for a in ask({"query": query, "pageSize": len(own)}).get("resultList", {}).get("result", []):
                            got.setdefault(key(a), a)
                    except Exception as e:
                        error = str(e) or type(e).__name__
                    for x in own:
                        a, why = got.get((source, x)), error
                        if a is None:
                            try:
                                a = ask({"source": source, "id": x}).get("result")
                            except Exception as e:
                                why = "; ".join(filter(None, (error, str(e) or type(e).__name__)))
                        record = article_row({"source": source, **a}) if a else [""] * len(ARTICLE_COLUMNS)
                        rows.append((source, x, *record, "" if a else why or "not found"))
            yield pd.DataFrame(rows, columns=["ref_source", "ref_id", *ARTICLE_COLUMNS, "error"])

    return asked(targets.select("ref_source", "ref_id"), lambda gate: partial(run, gate), _text_schema(["ref_source", "ref_id", *ARTICLE_COLUMNS, "error"]), rate)


def citation_counts(dois: DataFrame, transport: Transport, batch: int = CITATION_BATCH) -> DataFrame:
    """``doi, count`` of distinct DOIs, case aside. Batches are answered by position, so one is taken only with a good status and as
    many answers as DOIs; otherwise its DOIs have none. Only what a good batch leaves open is asked for singly, so a failing service
    is not stormed."""

    def good(answer: dict) -> bool:
        return answer.get("status_code", 200) == 200


    def run(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in found:
            rows = []
            for i in range(0, len(pdf), batch):
                own = list(pdf.doi[i : i + batch])
                try:
                    batch_answer = with_retries(lambda own=own: transport({"dois": own}))
                    answers = batch_answer.get("results", []) if good(batch_answer) else []
                except Exception:
                    answers = []
                if len(answers) != len(own):
                    rows += [(d, None) for d in own]
                    continue
                for d, a in zip(own, answers, strict=True):
                    n = (a or {}).get("citationCount")
                    if n is None:
                        try:
                            single = with_retries(lambda d=d: transport({"doi": d}))
                            n = single.get("citationCount") if good(single) else None
                        except Exception:
                            n = None
                    rows.append((d, n))
            yield pd.DataFrame(rows, columns=["doi", "count"]).astype({"count": "Int64"})

    return dois.select(F.lower(X.clean(F.col("doi"))).alias("doi")).filter("doi <> ''").distinct().mapInPandas(run, "doi string, count long")


# ---- liveness

CHECK_SCHEMA = T.StructType(
    [T.StructField(n, t) for n, t in (("url_key", T.StringType()), ("status", T.StringType()), ("status_code", T.IntegerType()), ("final_url", T.StringType()), ("method", T.StringType()), ("redirect_chain", T.ArrayType(T.StringType())), ("tls_warning", T.StringType()), ("error", T.StringType()))]
)


def check_urls(firsts: DataFrame, transport: Transport, budget: float = 120.0, clock=time.monotonic) -> DataFrame:
    """Each ``url_key, url`` tried by HEAD and GET over its spellings within one time budget, until one answers. The transport gets
    ``method, url, timeout, verify`` and gives ``status_code, url, text, history``; a certificate error is tried once more unverified."""
    from sievemill.functions import urls

    asked = firsts.select("url_key", urls.url_candidates(F.col("url")).alias("candidates"))

    def one(key: str, candidates: list[str]) -> tuple:
        end, tls, error, worst = clock() + budget, "", "", None
        for url in candidates:
            for method, cap in (("HEAD", 30.0), ("GET", 60.0)):
                for verify in (True, False):
                    left = end - clock()
                    if left <= 0:
                        return worst or (key, "", None, None, "", [], tls, error or "time is up")
                    try:
                        a = transport({"method": method, "url": url, "timeout": min(left, cap), "verify": verify})
                    except Exception as e:
                        error = str(e) or type(e).__name__
                        if verify and "certificate" in error.lower():
                            tls = error
                            continue
                        break
                    chain = [h["url"] for h in a.get("history", [])] + [a.get("url", url)]
                    row = (key, a.get("text", ""), a["status_code"], a.get("url", url), method, chain, tls, "")
                    if method == "GET" or a["status_code"] < 400:
                        if method == "HEAD" and a["status_code"] < 400:
                            break  # the body is needed to tell
                        if a["status_code"] < 400 or a["status_code"] in urls.RESTRICTED_CODES:
                            return row
                        worst = row
                    break
        return worst or (key, "", None, None, "", [], tls, error or "no answer")

    def run(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in found:
            rows = [one(k, list(c)) for k, c in zip(pdf.url_key, pdf.candidates, strict=True)]
            yield pd.DataFrame(rows, columns=["url_key", "body", "status_code", "final_url", "method", "redirect_chain", "tls_warning", "error"]).astype({"status_code": "Int32"})

    raw = asked.mapInPandas(run, "url_key string, body string, status_code int, final_url string, method string, redirect_chain array<string>, tls_warning string, error string")
    status = F.when(F.col("status_code").isNull(), F.lit("unreachable")).otherwise(urls.page_status(F.col("status_code"), F.col("body")))
    return raw.select("url_key", status.alias("status"), "status_code", "final_url", "method", "redirect_chain", "tls_warning", "error")


def chain_text(c: Column) -> Column:
    return F.array_join(c, " -> ")


# ---- models


def ask_model(rows: DataFrame, key: str, prompt: str, transport: Transport, attempts: int = 3, sleep=time.sleep) -> DataFrame:
    """``key, answer, usage, error`` of each prompt; a row that still fails after the retries has no answer, so the next run asks again."""

    def run(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in found:
            out = []
            for k, p in zip(pdf[key], pdf[prompt], strict=True):
                try:
                    a = with_retries(lambda p=p: transport({"prompt": p}), attempts, sleep)
                    out.append((k, a.get("text"), a.get("usage"), ""))
                except Exception as e:
                    out.append((k, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(out, columns=["key", "answer", "usage", "error"])

    return rows.select(F.col(key).cast("string").alias(key), prompt).mapInPandas(run, "key string, answer string, usage string, error string")
