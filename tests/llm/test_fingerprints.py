"""Fingerprints against a plain MinHash, edits against the texts, near-duplicates against all pairs."""

import base64
import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from sievemill.llm import fingerprints as M
from sievemill.llm import near_dup

from .cases import LONG, TEXTS, documents, text


def words_of(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    return [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in low).split(" ") if w]


def runs(t, n=5):
    own = [""] * (n - 1) + words_of(t)
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}


def sets(t):
    own = words_of(t)
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} if own else set()


def expected(rows):
    """In order, the id, length, edited text's digest and next text of each row; ids are distinct."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        new = t[: len(t) - half] + following[:half]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), t, new, following))
    return out


def jaccard(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def test_awkward_rows_in_many_partitions(spark):
    rows = [(i, t) for i, t in TEXTS if i != 12] + [(12, text(40, 2))]
    for parts in (1, 5):
        got = {r.doc_id: r for r in M.fingerprint_documents(documents(spark, rows).repartition(parts)).collect()}
        assert len(got) == len(rows)
        for i, n, digest, t, new, following in expected(rows):
            r = got[i]
            assert (r.n_chars, r.edited_sha256) == (n, digest)
            assert abs(r.near_edited - jaccard(runs(t), runs(new))) < 0.25 and abs(r.near_next - jaccard(runs(t), runs(following))) < 0.25
        assert got[1].fingerprint == got[2].fingerprint == got[3].fingerprint and got[5].fingerprint == got[6].fingerprint == got[7].fingerprint != got[8].fingerprint
        assert got[5].near_next == 1 and got[None].near_id is None
        assert [got[i].near_id for i in (1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 13)] == [1, 1, 1, 1, 5, 6, 8, 8, 10, 10, 13]


def test_one_row_repeated_rows_and_no_rows(spark):
    one = M.fingerprint_documents(documents(spark, [(1, "a b c d e f")])).collect()
    assert len(one) == 1 and one[0].near_next == 1 and one[0].edited_sha256 == hashlib.sha256(b"a b c a b c").hexdigest()
    assert M.fingerprint_documents(documents(spark, [])).collect() == []
    many = M.fingerprint_documents(documents(spark, [(7, text(30, 1))] * 50 + [(8, text(30, 2)), (7, text(30, 3))]).repartition(6)).collect()
    assert len(many) == 52 and {r.near_id for r in many if r.doc_id == 7} == {7} and sum(r.near_next == 1 for r in many) >= 48


def test_fingerprints_are_those_of_a_plain_minhash():
    def plain(t):
        words = M.word_hashes(t.encode(), np.array([0, len(t.encode())]))[0].tolist()
        own, mask = [int(M._BLANK)] * 4 + words, (1 << 64) - 1
        best = [0xFFFFFFFF] * M.HASHES
        for i in range(len(own) - 4):
            h = 0x13198A2E03707344
            for w in own[i : i + 5]:
                h = (h ^ w) * 0x9E3779B97F4A7C15 & mask
                h ^= h >> 32
            best = [min(b, (h * int(f) + int(s) & mask) >> 32) for b, f, s in zip(best, M._FACTORS, M._SHIFTS, strict=True)]
        return [b & 0xFFFF for b in best]

    texts = ["", "one", "One TWO three", text(40, 4), text(7, 1), " \n "]
    got, keys = M.fingerprints([t.encode() for t in texts])
    assert got.tolist() == [plain(t) for t in texts]
    assert [bool(k) for k in keys] == [False, True, True, True, True, False]
    assert M.as_text(got)[3] == base64.b64encode(np.array(plain(texts[3]), np.uint16).tobytes()).decode()


def test_a_long_text_in_segments_has_the_same_fingerprint():
    raw = LONG.encode()
    whole, keys = M.fingerprints([raw, b"x y"], segment=1 << 26)
    cut, cut_keys = M.fingerprints([raw, b"x y"], segment=5000)
    assert (whole == cut).all() and keys == cut_keys


def test_likeness_follows_jaccard_similarity():
    rng, errors = random.Random(3), []
    for share in (0.1, 0.3, 0.5, 0.7, 0.9):
        base = [f"w{k}" for k in range(400)]
        cut = int(400 * share)
        x, y = " ".join(base), " ".join(base[:cut] + [f"v{rng.random()}" for _ in range(400 - cut)])
        prints, _ = M.fingerprints([x.encode(), y.encode()])
        errors.append(abs(M.likeness(prints[0], prints[1]) - jaccard(runs(x), runs(y))))
    assert max(errors) < 0.2


def near_ids(rows):
    own = {i: sets(t) for i, t in rows}
    parent = {i: i for i in own}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(own)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if own[i] and own[j] and 100 * len(own[i] & own[j]) >= 75 * len(own[i] | own[j]):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i in ids}


def test_near_documents_against_all_pairs(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for family in range(12):
        base = [f"f{family}w{k}" for k in range(120)]
        for _ in range(6):
            own = list(base)
            for k in rng.sample(range(120), rng.choice((0, 1, 2, 3))):
                own[k] = f"x{rng.random()}"
            rows.append((n, " ".join(own)))
            n += 1
    # one hub whose leaves are near to it but not to one another, all under a smaller document that shares only a passage with them
    hub = [f"h{k}" for k in range(200)]
    rows.append((n, " ".join(hub[:80] + [f"o{k}" for k in range(120)])))
    rows.append((n + 1, " ".join(hub)))
    for leaf in range(60):
        own = list(hub)
        at = (leaf * 37) % 170
        own[at : at + 22] = [f"l{leaf}x{k}" for k in range(22)]
        rows.append((n + 2 + leaf, " ".join(own)))
    rng.shuffle(rows)
    want = near_ids(rows)
    got = {r.doc_id: r.near_id for r in M.fingerprint_documents(documents(spark, rows)).collect()}
    assert sum(got[i] != want[i] for i in want) <= 1  # a pair at the threshold shares no band with a chance of 0.002


def test_the_join_compares_sketches_as_arrays_are(spark):
    rng = random.Random(9)
    sets = [np.array(sorted(rng.sample(range(1 << 20), rng.randint(1, 400))), np.uint64) * np.uint64(1 << 44) for _ in range(30)]
    sets += [np.unique(np.concatenate([x[: int(len(x) * rng.random())], sets[0]])) for x in sets]
    wide = np.stack([np.frombuffer(near_dup.wide_sketch(x), np.int64) for x in sets])
    table = spark.createDataFrame([(k, len(x), w.tolist()) for k, (x, w) in enumerate(zip(sets, wide, strict=True))], "id int, size long, wide array<long>")
    joined = table.alias("x").join(table.alias("y"), F.col("x.id") < F.col("y.id"))
    got = {(r[0], r[1]) for r in joined.filter(M.may_be_linked("x", "y")).select("x.id", "y.id").collect()}
    words, want = wide.view(np.uint64), set()
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            one, other = np.array([len(sets[a])]), np.array([len(sets[b])])
            if near_dup._fits(one, other)[0] and near_dup._may_be_linked(words[a : a + 1], words[b : b + 1], one, other)[1][0]:
                want.add((a, b))
    assert got == want and 10 < len(want) < 1000


def test_blocks_of_a_band_meet_like_all_pairs(spark, monkeypatch):
    rng = random.Random(11)
    base = [rng.sample(range(1 << 20), 120) for _ in range(3)]
    sets = [np.array(sorted({*rng.sample(base[k % 3], rng.randint(90, 120)), *rng.sample(range(1 << 20), rng.randint(0, 20))}), np.uint64) * np.uint64(1 << 44) for k in range(120)]
    sketches = spark.createDataFrame([(k, len(x), bytearray(near_dup.wide_sketch(x))) for k, x in enumerate(sets)] + [(7, 3, bytearray(near_dup.wide_sketch(sets[0][:3])))], "id long, size long, wide binary")
    # bands 0 and 1 mix components, in band 2 all are in that of the smallest; -1 is the component of theirs
    own = [(band, k, (-1 if k % 4 == 0 or band == 2 else k // 5), -1) for band in range(3) for k in range(band * 10, 100)]
    monkeypatch.setattr(M, "BLOCK", 16)
    blocks = M._in_blocks(spark.createDataFrame(own, "band long, id long, component long, of_leader long"), sketches)
    assert {r.band for r in blocks.select("band").distinct().collect()} == {0, 1} and blocks.count() >= 10
    got = [(r.a, r.b) for r in M._near_pairs(blocks).collect()]
    words = np.stack([np.frombuffer(near_dup.wide_sketch(x), np.uint64) for x in sets])
    where, want = {k: c for band, k, c, _ in own if band == 0}, set()
    for a in range(100):
        for b in range(a + 1, 100):
            one, other = np.array([len(sets[a])]), np.array([len(sets[b])])
            if where[a] != where[b] and near_dup._fits(one, other)[0] and near_dup._may_be_linked(words[a : a + 1], words[b : b + 1], one, other)[1][0]:
                want.add((a, b))
    assert len(got) == len(set(got)) and set(got) == want and 100 < len(want) < 2000


def test_a_bit_table_takes_no_job_for_each_partition(spark):
    conf = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("bit table", "")
        table, bits = near_dup.bit_table(spark.range(100_000).withColumnRenamed("id", "doc_id"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("bit table")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(jobs) < 10
    places = {r[0] for r in spark.range(100_000).select(near_dup._place(F.col("id"), bits)).collect()}
    assert {int(x) for x in np.flatnonzero(np.unpackbits(table, bitorder="little"))} == places


def test_the_query_has_every_row_of_the_table(spark, sf):
    got = {r.doc_id: r for r in M.op11_fingerprints(spark, sf).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    for i, n, digest, *_ in expected(rows):
        assert (got[i].n_chars, got[i].edited_sha256) == (n, digest)
    want = near_ids(rows)
    assert {i: r.near_id for i, r in got.items()} == want
    assert np.mean([r.near_edited for r in got.values()]) > 0.25 > 10 * np.mean([r.near_next for r in got.values()])
