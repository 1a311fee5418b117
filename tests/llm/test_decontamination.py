import re

import numpy as np
from pyspark.sql import types as T

from sievemill.llm import decontamination as D

from . import cases

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.LongType())])


def items(spark, rows):
    return spark.createDataFrame([(i, t, 5) for i, t in rows], ITEMS)


def brute(texts, bench):
    """The best stretch over every diagonal, with at most one differing token in five, and a hit of five equal tokens or a seed."""
    found = set()
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    for i, t in texts:
        a = tok(t)
        for j, b in bench:
            b = tok(b)
            if len(b) < D.SHORTEST:
                continue
            for shift in range(-len(b) + 1, len(a)):
                best = run = n = 0
                for k in range(max(0, -shift), min(len(b), len(a) - shift)):
                    n, run = (n + 1, run + (1 if a[k + shift] == b[k] else -D.COST)) if run > 0 or a[k + shift] == b[k] else (0, 0)
                    if run <= 0:
                        n = run = 0
                    best = max(best, n if a[k + shift] == b[k] else 0)
                if best >= min(D.LEAST, len(b)):
                    found.add((i, j))
    return found


def planted():
    rng = np.random.default_rng(1)
    bench = [(j, cases.text(int(rng.integers(15, 50)), 400 + j)) for j in range(12)] + [(50, "seven of nine are too short"), (51, "one two three"), (52, None), (53, "")]
    docs = []
    for i in range(40):
        words = cases.text(120, 900 + i).split()
        if i % 2:
            own = bench[i % 12][1].split()
            if i % 4 == 1:  # every seventh token substituted
                own = [f"sub{k}" if k % 7 == 3 else w for k, w in enumerate(own)]
            words[30:30] = own if i % 6 else own[:14]
        docs.append((i, " ".join(words)))
    docs.append((99, "He said: Seven of NINE, are too short!"))
    return docs, bench


def test_leaks_are_those_of_all_diagonals(spark):
    docs, bench = planted()
    got = {(r.doc_id, r.item_id) for r in D.leaks(cases.documents(spark, docs), items(spark, bench)).collect()}
    want = brute(docs, bench)
    assert got == want and {i for i, _ in got} == {i for i, _ in docs if i % 2}


def longest(texts, bench):
    """The longest stretch of each text and item over every diagonal with at most one differing token in five."""
    found = {}
    for i, t in texts:
        a = t.lower().split()
        for j, b in bench:
            b = b.lower().split()
            for shift in range(-len(b) + 1, len(a)):
                same = [a[k + shift] == b[k] for k in range(max(0, -shift), min(len(b), len(a) - shift))]
                for s in range(len(same)):
                    for e in range(s + min(D.LEAST, len(b)), len(same) + 1):
                        if 5 * (e - s - sum(same[s:e])) <= e - s:
                            found[i, j] = max(found.get((i, j), 0), e - s)
    return found


def test_substitutions_at_every_place(spark):
    sizes = (5, 7, 9, 13, 15, 16, 20)
    bench = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in sizes]
    docs = []
    for n, t in bench:
        for p in range(n):
            for q in range(p, n, 3):
                own = t.split()
                own[p] = own[q] = "other"
                docs.append((len(docs), " ".join(["before", "it", *own, "after", "it"])))
    want = longest(docs, bench)
    got = {(r.doc_id, r.item_id): r.length for r in D.leaks(cases.documents(spark, docs), items(spark, bench)).collect()}
    assert got == want and len(want) > len(docs) / 2


def test_short_items_leak_word_for_word(spark):
    bench = [(1, "zebra"), (2, "red fox"), (3, "a b c"), (4, "one two three four"), (5, "!")]
    docs = [(1, "the Zebra."), (2, "a red-fox"), (3, "x a b c d"), (4, "one two three four"), (5, "fox red, a b d, one two three five")]
    got = {(r.doc_id, r.item_id) for r in D.leaks(cases.documents(spark, docs), items(spark, bench)).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4)}


def test_blocks_do_not_matter(spark, monkeypatch):
    docs, bench = planted()
    whole = {tuple(r) for r in D.leaks(cases.documents(spark, docs), items(spark, bench)).collect()}
    monkeypatch.setattr(D, "BLOCK_TOKENS", 60)
    assert len(list(D.blocks(items(spark, bench)))) > 3
    assert {tuple(r) for r in D.leaks(cases.documents(spark, docs), items(spark, bench)).collect()} == whole


def test_filter_keeps_clean_rows_whole(spark):
    docs, bench = planted()
    df = cases.documents(spark, docs)
    kept = D.without_leaks(df, items(spark, bench))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in docs if i % 2 == 0}


def test_awkward_rows(spark):
    df = cases.documents(spark)
    bench = items(spark, [(None, cases.text(40, 2)), (1, cases.text(40, 2)), (2, "!!!")])
    got = sorted((r.doc_id, r.item_id or -1) for r in D.leaks(df, bench).collect())
    assert got == [(12, -1), (12, -1), (12, 1), (12, 1)]
    assert D.leaks(df, items(spark, [])).count() == 0 and D.leaks(cases.documents(spark, []), bench).count() == 0
    assert D.without_leaks(df, items(spark, [])).count() == len(cases.TEXTS)


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in D.op6_spaced_seeds(spark, sf).collect()}
    exact = {(i, j) for i, t in docs.items() for j, b in bench.items() if b in t}
    assert exact <= got


def stretches(texts, bench):
    """Whether some stretch on some diagonal is long enough, over all diagonals at once."""
    found = set()
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    words = {}
    number = lambda t: np.array([words.setdefault(w, len(words)) for w in tok(t)], np.int64)
    bench = [(j, number(t)) for j, t in bench]
    for i, t in texts:
        a = number(t)
        for j, b in bench:
            if not len(a) or not len(b):
                continue
            least, n = min(D.LEAST, len(b)), len(b)
            at = np.arange(-n + 1, len(a))[:, None] + np.arange(n)
            inside = (at >= 0) & (at < len(a))
            same = (a[np.where(inside, at, 0)] == b) & inside
            score = np.where(same, 1, np.where(inside, -4, -10_000))
            run = np.concatenate([np.zeros((len(at), 1), int), np.cumsum(score, 1)], 1)
            if (run[:, least:] >= np.minimum.accumulate(run, 1)[:, : n + 1 - least]).any():
                found.add((i, j))
    return found


def test_query_is_all_diagonals(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text) < 20_000]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    short = {i for i, _ in docs}
    got = {(r.doc_id, r.item_id) for r in D.op6_spaced_seeds(spark, sf).collect() if r.doc_id in short}
    assert got == stretches(docs, bench) and got


def test_repeated_words_stay_within_bounds():
    import time
    import tracemalloc

    items = [(k, D.tokens(["alpha " * 40 if k % 2 else "alpha beta " * 20])[0]) for k in range(20)]
    texts = ["alpha " * 20_000, "alpha beta " * 10_000, "alpha beta gamma " * 5_000, "beta " * 12 + "alpha " * 3]
    block = D.Block(items)
    tracemalloc.start()
    began = time.time()
    got = block.overlaps(texts)
    took, (_, peak) = time.time() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert took < 20 and peak < 600 << 20, (took, peak)
    by = {(t, i): rest for t, i, *rest in got}
    assert all(by[0, k] == [0, 40, 40] for k in range(1, 20, 2)) and all(by[1, k] == [0, 40, 40] for k in range(0, 20, 2))
    small = [(t, " ".join(x.split()[:150])) for t, x in enumerate(texts)]
    bench = [(k, "alpha " * 40 if k % 2 else "alpha beta " * 20) for k in range(4)]
    some = D.Block([(k, D.tokens([x])[0]) for k, x in bench])
    short = {(t, i): n for t, i, _, n, _ in some.overlaps([x for _, x in small])}
    assert short == longest(small, bench)
