from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from sievemill.llm import near_dup

from . import cases


def brute(rows):
    """Components and set sizes by comparing all pairs that share a shingle."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            held[g].append(i)
    for i, s in sets.items():
        common = Counter(j for g in s for j in held[g] if j < i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_query_is_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.op3_minhash_forest(spark, sf).collect()}
    assert got == brute(rows)


def edited(words, places):
    out = list(words)
    for p in places:
        out[p] = f"x{p}"
    return " ".join(out)


def test_edits_around_the_threshold(spark):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for d in range(60):
        words = cases.text(120, 1000 + d).split()
        for n_edits in range(4):
            rows.append((k, edited(words, rng.choice(len(words), n_edits, replace=False))))
            k += 1
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(cases.documents(spark, rows)).collect()}
    assert got == brute(rows)


def test_large_groups_of_copies(spark):
    words = cases.text(100, 77).split()
    rows = [(i, " ".join(words)) for i in range(600)] + [(1000 + i, edited(words, [i % 90])) for i in range(300)] + [(5000 + i, cases.text(50, 5000 + i)) for i in range(100)]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(cases.documents(spark, rows)).collect()}
    want = {i: c for i, (_, c) in brute(rows).items()}
    assert got == want


def test_hub_of_copies_that_are_not_alike(spark):
    rng = np.random.default_rng(8)
    words = cases.text(400, 55).split()
    # each leaf has edits of its own: about 0.76 with the hub, 0.58 with one another
    leaf = lambda: " ".join(f"y{rng.integers(1 << 40)}" if p in places else w for p, w in enumerate(words))
    rows = [(0, " ".join(words))]
    for i in range(1, 1001):
        places = set((np.arange(11) * 36 + rng.integers(2, 30, 11)).tolist())
        rows.append((i, leaf()))
    want = brute(rows)
    assert {c for _, c in want.values()} == {0}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(cases.documents(spark, rows)).collect()}
    assert got == want


def test_awkward_rows(spark):
    rows = near_dup.near_duplicates(cases.documents(spark)).collect()
    assert len(rows) == len(cases.TEXTS)
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert {by[i][0].component_id for i in (1, 2, 3, 4)} == {1} and [by[i][0].kept for i in (1, 2)] == [True, False]
    assert by[8][0].component_id == by[9][0].component_id == 8 and by[8][0].n_shingles == 1
    for i in (5, 6, 7):
        assert (by[i][0].n_shingles, by[i][0].component_id, by[i][0].kept) == (0, i, True)
    assert by[11][0].component_id == 10 and len(by[12]) == 2 and by[None][0].component_id is None and by[None][0].kept


def test_one_of_each_group_stays(spark):
    docs = cases.documents(spark)
    kept = near_dup.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 5, 6, 7, 8, 10, 12, 13, 14, 15, 16, 17, 18] and ids.count(None) == 1
    assert near_dup.deduplicate(cases.documents(spark, [])).count() == 0


def test_sketch_estimates():
    a = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x, y = near_dup.signature(np.sort(a[:900])), near_dup.signature(np.sort(a[100:]))
    assert (x == y).mean() == pytest.approx(0.8, abs=0.15)


def test_wide_sketch_estimates():
    rng = np.random.default_rng(1)
    for n in (40, 400, 20_000):
        both = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 2 * n, dtype=np.uint64)
        for apart, good in ((0.12, True), (0.4, False)):
            k = int(n * apart)
            x, y = np.unique(both[:n]), np.unique(both[k : n + k])
            rows = [np.frombuffer(near_dup.wide_sketch(s), np.uint64)[None] for s in (x, y)]
            share, may = near_dup._may_be_linked(*rows, np.array([n]), np.array([n]))
            assert share[0] == pytest.approx((1 - apart) / (1 + apart), abs=0.1) and may[0] == good


def near_copies(n, n_words=150):
    """Copies of one text that differ in a few words of their own."""
    rng = np.random.default_rng(12)
    words = cases.text(n_words, 31).split()
    return [(i, edited([w if p != i % n_words else f"v{i}" for p, w in enumerate(words)], rng.choice(n_words, 1 + i % 2, replace=False))) for i in range(n)]


def test_a_large_group_of_near_copies(spark):
    rows = near_copies(5000) + [(10_000 + i, cases.text(60, 20_000 + i)) for i in range(200)]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in near_dup.near_duplicates(cases.documents(spark, rows).repartition(7)).collect()]
    assert {c for i, _, c in got if i < 10_000} == {0} and all(i == c for i, _, c in got if i >= 10_000)
    again = [(r.doc_id, r.n_shingles, r.component_id) for r in near_dup.near_duplicates(cases.documents(spark, rows).repartition(3)).collect()]
    assert sorted(got) == sorted(again)


def test_passages_that_many_share(spark):
    # two texts in five share nothing but a long passage: the runs are crowded, and copies among them are still found
    passage = cases.text(70, 3)
    rows = []
    for i in range(900):
        own = cases.text(60, 50_000 + i).split()
        rows.append((2 * i, passage + " " + " ".join(own)))
        if i % 9 == 0:
            rows.append((2 * i + 1, passage + " " + edited(own, [7, 33])))
    want = {i: v for i, v in brute(rows).items()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(cases.documents(spark, rows)).collect()}
    assert got == want and len({c for _, c in want.values()}) == 900


def test_texts_that_share_an_id_are_one_document(spark):
    a, b = cases.text(60, 1), cases.text(60, 2)
    rows = near_dup.near_duplicates(cases.documents(spark, [(1, a), (5, a), (2, b), (5, b), (7, a + " x"), (7, None)])).collect()
    assert {r.component_id for r in rows if r.n_shingles} == {1} and len(rows) == 6
    alone = near_dup.near_duplicates(cases.documents(spark, [(5, a), (5, b), (5, b), (6, b + " x")])).collect()
    assert {r.component_id for r in alone} == {5}


def test_written_tables_go(spark):
    before = cases.written_tables(spark)
    near_dup.near_duplicates(cases.documents(spark)).count()
    assert len(cases.written_tables(spark) - before) == 1


def test_recall_over_ten_thousand_documents(spark):
    sf = Path("/root/testdata/sf0.1")
    if not sf.exists():
        pytest.skip("test tables are not here")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()}
    joined = [i for i, (_, c) in want.items() if c != i]
    assert len(joined) > 300 and sum(got[i] == want[i] for i in joined) >= 0.999 * len(joined)
    assert all(got[i][0] == n for i, (n, _) in want.items()) and all(got[i][1] == c for i, (_, c) in want.items() if c == i)
