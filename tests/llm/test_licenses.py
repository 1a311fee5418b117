import math
import re

from sievemill.llm import licenses as L

from . import cases


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(t):
    w, starts, base = words(t), [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k : k + len(p)] == p:
                starts.append(k)
                base.add(label)
    more, best = set(), 0.0
    for line in (t or "").split("\n"):
        own, found = set(words(line)), []
        for label, text in L.TEMPLATES:
            s = set(text.split())
            if len(s & own) >= math.ceil(L.CONTAINMENT * len(s) - 1e-9):
                found.append((len(s & own), label))
                best = max(best, len(s & own) / len(s))
        more |= {la for n, la in found if n == max(found)[0]}
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if starts else best


def result(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score


TEXTS = [
    "Released under the MIT License.", "x under the mit license under the MIT\nlicense y Under the-MIT_license", "Licensed under the Apache License, Version 2.0", "licensed under cc by-nc 4.0 CC BY NC", "under the mit", "under the mİt license", "under the mit licenseé",
    "This work is licensed under the GNU General Public License, version 3.", "this work is licensed under a creative commons attribution noncommercial 4.0 international license", "this work is licensed under a creative commons attribution 4.0 international license",
    "the work\nlicensed under version", "mit license the under released zzz " * 3, "under the mit license " * 50, "\n\n", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation",
]


def test_all_texts_are_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + k, t) for k, (_, t) in enumerate(cases.TEXTS)]
    got = {r.doc_id: result(r) for r in L.scan(cases.documents(spark, rows)).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_rows_stay_rows(spark):
    rows = [(1, TEXTS[0]), (1, TEXTS[0]), (None, TEXTS[0]), (None, None)]
    got = L.scan(cases.documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.labels) for r in got) == [(0, ""), (0, "mit"), (1, "mit"), (1, "mit")]
    assert L.scan(cases.documents(spark, [])).count() == 0


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = L.op10_license_join(spark, sf)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert {r.doc_id: result(r) for r in out.collect()} == {i: brute(t) for i, t in docs.items()}


def test_every_notice_of_a_line_counts(spark):
    by = {label: [t for la, t in L.TEMPLATES if la == label] for label, _ in L.TEMPLATES}
    both = by["gpl"][0] + ". " + by["bsd"][0]
    nc = "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"
    got = {r.doc_id: r.labels for r in L.scan(cases.documents(spark, [(1, both), (2, by["isc"][0] + " or " + by["mit"][1]), (3, nc)])).collect()}
    assert got == {1: "bsd,gpl", 2: "isc,mit", 3: "cc-by-nc"}


def test_wrapped_notices(spark):
    rows, want = [], {}
    for k, (label, text) in enumerate(L.TEMPLATES):
        own = text.split()
        for n in (4, 7, 12):
            wrapped = "\n".join("# " + " ".join(own[i : i + n]) for i in range(0, len(own), n))
            rows.append((len(rows), "\n".join([cases.text(17 * k + n, k), wrapped, cases.text(90, k + 1)])))
            want[rows[-1][0]] = label
    got = {r.doc_id: (r.labels.split(","), r.score) for r in L.scan(cases.documents(spark, rows)).collect()}
    assert all(label in got[i][0] and got[i][1] == 1.0 for i, label in want.items())
