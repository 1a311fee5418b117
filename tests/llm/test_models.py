import math
import tracemalloc
import unicodedata
import zlib
from pathlib import Path

import numpy as np
import pytest

from sievemill.llm import language, toxicity
from sievemill.llm.ngrams import Words

from . import cases


def auc(y, s):
    y, s = np.array(y), np.array(s)
    return (s[y == 1][:, None] > s[y == 0][None]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None]).mean()


def toy(n, seed, odd=()):
    rng = np.random.default_rng(seed)
    texts, y = [], []
    for i in range(n):
        words = cases.text(int(rng.integers(20, 400)), seed * 1000 + i).split()
        y.append(i % 3 == 0)
        if y[-1]:
            for _ in range(1 + len(words) // 60):
                words[int(rng.integers(len(words)))] = str(rng.choice(odd or ["wretched", "scoundrel", "imbecile"]))
        texts.append(" ".join(words))
    return texts, np.array(y, int)


def test_training_keeps_few_bytes_for_each_n_gram():
    texts = [" ".join(f"w{i}x{k}abcdefgh" for k in range(400)) for i in range(120)]
    kept = [toxicity.bags([t]) for t in texts]
    grams = sum(len(bucket) for bucket, _, _ in kept)
    for own in kept:
        assert all(np.array_equal(x, y) for x, y in zip(own, toxicity.narrow(*own), strict=True))
    held, bags = [], toxicity.bags
    del kept, own
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "bags", lambda t: held.append(tracemalloc.get_traced_memory()[0]) or bags(t))
        tracemalloc.start()
        try:
            toxicity.fit(texts, np.arange(120) % 2, 0.5, epochs=0)
        finally:
            tracemalloc.stop()
    assert (held[-1] - held[0]) < 8 * grams


def test_toxic_words_and_their_misspellings():
    texts, y = toy(300, 1)
    model = toxicity.fit(texts, y, 0.33)
    seen, y1 = toy(90, 2)
    unseen, y2 = toy(90, 3, odd=("wretchedd", "scoundrell", "imbeciles"))
    assert auc(y1, model.scores(seen)) > 0.97
    assert auc(y2, model.scores(unseen)) > 0.95
    assert (model.scores(seen)[y1 == 0] < 0.5).mean() > 0.95


def test_a_long_text_is_not_diluted():
    texts, y = toy(300, 1)
    model = toxicity.fit(texts, y, 0.33)
    clean = cases.text(5000, 9)
    words = clean.split()
    words[4321] = "scoundrel"
    low, high = model.scores([clean, " ".join(words)])
    assert high > low + 0.2


def test_windows_are_means_of_two_blocks():
    sums, counts, first = np.array([4.0, 2.0, 6.0]), np.array([100, 100, 100]), np.array([0, 2, 3])
    assert toxicity.windows(sums, counts, first).tolist() == [0.03, 0.02, 0.06]


def test_words():
    w = Words(["A bc, d", "", "x1 é"], numbers=True)
    assert w.bounds.tolist() == [0, 3, 3, 5] and w.count == 5
    assert Words(["a b a", "a"]).first_of_each().tolist() == [True, True, False, True]
    gram, word = Words(["abc"]).grams(3, 16)
    assert len(gram) == 3 and set(word.tolist()) == {0}


def test_toxicity_query(spark, sf):
    rows = toxicity.op2_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_labels_of_the_held_out_fold_change_nothing(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, other)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_toxicity_of_awkward_rows(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 0), (None, 1), (8, None), (999, 1), (1, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model, "toxicity")
    assert out.columns == [*docs.columns, "toxicity"] and out.count() == len(cases.TEXTS)
    with pytest.raises(ValueError):
        toxicity.score(docs, model, "Score")
    alone = toxicity.train(docs, labels.filter("toxic = 0"))
    assert max(r.toxicity for r in toxicity.score(docs, alone, "toxicity").collect()) < 1e-6
    assert toxicity.score(cases.documents(spark, []), model, "toxicity").count() == 0
    assert toxicity.train(docs, labels.limit(0)).bias < 0


def test_language_of_held_out_documents(spark, sf):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in language.op7_language_mixture(spark, sf).collect() if r.held_out]
    assert rows and np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.97


def model_of(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the and this of there with", "en"), ("der die das und nicht ein", "de"), ("le la les une dans avec", "fr")] * 20)]
    return language.train(spark.createDataFrame([(i, t, la, None, None, None, None) for i, t, la in rows], cases.SCHEMA))


def test_mixtures(spark):
    model = model_of(spark)
    share, _ = model.proportions(["the and this of there with " * 3 + "der die das und nicht ein " * 2, "the and of this", ""])
    names = model.names
    assert names == ["de", "en", "fr"]
    assert share[0][0] == pytest.approx(0.4, abs=0.05) and share[0][1] == pytest.approx(0.6, abs=0.05) and share[0][2] == 0
    assert share[1].tolist() == [0, 1, 0] and share[2].tolist() == [0, 0, 0]


def test_language_of_awkward_rows(spark):
    docs = cases.documents(spark)
    model = model_of(spark)
    rows = language.identify(docs, model, "found", "share").collect()
    got = {r.doc_id: r.found for r in rows}
    assert len(rows) == len(cases.TEXTS)
    assert {i for i, v in got.items() if v == "und"} == {5, 6, 7, 15}
    nothing = language.train(docs.filter("lang is null"))
    assert {r.found for r in language.identify(docs, nothing, "found", "share").collect()} == {"und"}
    assert language.identify(cases.documents(spark, []), model, "found", "share").count() == 0


def test_labels_without_a_usable_text_take_no_place(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_CLASS", 6)
    docs = cases.documents(spark, [(i, cases.text(30, i) + (" awful" if i % 2 else "")) for i in range(40)] + [(i, "long " * 2000) for i in range(40, 400)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels).weights.any()


# ---- the same in plain Python, a word at a time


def plain_words(text, kinds="L"):
    out, word = [], ""
    for ch in text.lower() + " ":
        if unicodedata.category(ch)[0] in kinds:
            word += ch
        elif word:
            out.append(word)
            word = ""
    return out


def plain_grams(word, n, bits):
    spaced = [0x20, *map(ord, word), 0x20]
    for i in range(len(spaced) - n + 1):
        h = n
        for code in spaced[i : i + n]:
            h = (h * 0x01000193 & 0xFFFFFFFF) ^ code
        h = h * 0x9E3779B1 & 0xFFFFFFFF
        h = (h ^ h >> 15) * 0x85EBCA6B & 0xFFFFFFFF
        yield h >> 32 - bits


def plain_toxicity(model, text):
    seen = list(dict.fromkeys(plain_words(text, "LN")))
    blocks = [seen[i : i + toxicity.HALF] for i in range(0, len(seen), toxicity.HALF)] or [[]]
    best = -math.inf
    for i in range(len(blocks)):
        grams = [g for block in blocks[i : i + 2] for w in block for n in toxicity.GRAMS for g in plain_grams(w, n, toxicity.BITS)]
        best = max(best, sum(float(model.weights[g]) for g in grams) / max(len(grams), toxicity.FULL))
    return 1 / (1 + math.exp(-max(-30, min(30, best + model.bias))))


def test_toxicity_is_the_plain_scorer_s(spark):
    texts, y = toy(120, 1)
    model = toxicity.fit(texts, y, 0.33)
    texts = [*texts[:40], *(t or "" for _, t in cases.TEXTS if len(t or "") < 5000), "É1 x", "the the the the", "a"]
    assert model.scores(texts) == pytest.approx([plain_toxicity(model, t) for t in texts], abs=1e-6)


def plain_mixture(model, text):
    words, k = plain_words(text), len(model.names)
    if not words:
        return [0.0] * k
    like = []
    for w in words:
        logs = [sum(float(model.log_p[g, j]) for g in plain_grams(w, language.GRAM, language.BITS)) for j in range(k)]
        like.append([max(math.exp(x - max(logs)), 1e-12) for x in logs])

    def infer(share, allowed, rounds):
        share = [max(s, 1e-3) if j in allowed else 0.0 for j, s in enumerate(share)]
        share = [s / sum(share) for s in share]
        for _ in range(rounds):
            total = [0.0] * k
            for row in like:
                mixed = [a * b for a, b in zip(row, share, strict=True)]
                total = [t + m / sum(mixed) for t, m in zip(total, mixed, strict=True)]
            share = [t / len(words) for t in total]
        value = sum(math.log(sum(a * b for a, b in zip(row, share, strict=True))) for row in like)
        return share, value - 0.5 * math.log(len(words) + 1) * len(allowed)

    allowed = set(range(k))
    share, value = infer([1 / k] * k, allowed, language.ROUNDS)
    while len(allowed) > 1:
        fewer = allowed - {min(sorted(allowed), key=lambda j: share[j])}
        new, worth = infer(share, fewer, language.ROUNDS // 2)
        if worth < value:
            break
        share, value, allowed = new, worth, fewer
    return share


def test_mixtures_are_the_plain_ones(spark, sf):
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text) < 3000][:60]
    model = language.train(spark.read.parquet(f"{sf}/documents.parquet"))
    texts = [*docs, docs[0][:300] + " " + docs[1][:300], "", "12 !", *(t or "" for _, t in cases.TEXTS if len(t or "") < 2000)]
    got, _ = model.proportions(texts)
    assert got == pytest.approx(np.array([plain_mixture(model, t) for t in texts]), abs=1e-6)


def test_toxicity_of_held_out_documents(spark):
    sf = Path("/root/testdata/sf0.1")
    if not sf.exists():
        pytest.skip("test tables are not here")
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic is not None}
    rows = [r for r in toxicity.op2_toxicity(spark, str(sf)).collect() if r.held_out and r.doc_id in truth]
    y, s = [truth[r.doc_id] for r in rows], [r.score for r in rows]
    called = np.array([r.predicted for r in rows])
    assert sum(y) > 20 and auc(y, s) > 0.95
    assert called[np.array(y) == 1].mean() > 0.85 and called[np.array(y) == 0].mean() < 0.02


def test_training_does_not_depend_on_the_order_of_texts(spark):
    rows = [(i % 30, cases.text(30, i) + (" awful" if i % 2 else "")) for i in range(90)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    a, b = (toxicity.train(cases.documents(spark, r).repartition(n), labels) for r, n in ((rows, 2), (rows[::-1], 5)))
    assert np.array_equal(a.weights, b.weights) and a.weights.any()


ODD = "Ünïcode ΟΔΟΣ x1²½ don't\n" + "z" * 700 + " 日本語 … İstanbul\t"


def test_pieces_of_a_long_text_give_what_the_whole_gives():
    from sievemill.llm.ngrams import cut

    text = ODD + cases.text(3000, 4) + ODD + "scoundrel " + cases.text(2000, 5).upper()
    for size in (1, 64, 1000):
        pieces = list(cut(text, size))
        assert "".join(pieces) == text and sum(Words([p], numbers=True).count for p in pieces) == Words([text], numbers=True).count
    texts, y = toy(120, 1)
    model = toxicity.fit(texts, y, 0.33)
    whole = model.sums([text.lower()])
    for size in (50, 777):
        for a, b in zip(whole, model.sums_of_long(text, size), strict=True):
            assert np.allclose(a, b)
        assert np.allclose(model.scores([text], size), model.scores([text]))
    assert np.allclose(model.scores(["..." * 500], 100), model.scores([""]))
    rng = np.random.default_rng(1)
    mixture = language.Model(["a", "b", "c"], np.log(rng.dirichlet(np.ones(1 << language.BITS), 3).T).astype(np.float32))
    for size in (50, 777):
        assert np.allclose(mixture.proportions([text], size)[0], mixture.proportions([text])[0])
    assert not mixture.proportions(["123 " * 500], 100)[1].any()


def test_a_text_of_forty_megabytes_takes_bounded_memory():
    """In a process of its own, whose peak is measured."""
    import subprocess
    import sys
    import textwrap

    code = """
        import resource, sys
        import numpy as np
        from sievemill.llm import toxicity
        words = [f"w{k}" for k in range(200_000)]
        text = " ".join(words) + " " + " ".join(words[:1000]) * 6000
        assert len(text) > 30_000_000
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        model = toxicity.Model(np.zeros(1 << toxicity.BITS, np.float32), 0.0)
        assert model.scores([text])[0] == 0.5
        print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, check=True, timeout=600, cwd=Path(__file__).parents[2])
    assert int(out.stdout) < 1000
