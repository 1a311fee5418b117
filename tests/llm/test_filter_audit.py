"""The audit against filters applied one after the other to a list of rows."""

import itertools
import re

from .cases import LONG, documents, text
from pyspark.sql import types as T

from sievemill.llm import filter_audit as M


def failures(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {
        f
        for f, bad in (("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)), ("C", 100 * len(re.findall("[A-Z]", t)) > 3 * len(t)), ("D", bool(re.search(r"[#$%&*|]", t))))
        if bad
    }


def plain(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    marks = {}
    for i, quality, toxic in labels:
        if i is not None:
            good, bad = marks.get(i, (False, False))
            marks[i] = good or quality == 1, bad or toxic == 1
    parts = {}
    for i, t, lang in rows:
        bad = failures(t or "") | ({"E"} if i is not None and i > first[t or ""] else set())
        parts.setdefault(lang or "", []).append((bad, *marks.get(i, (False, False))))
    out = {}
    for part, own in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                fails = sum(f in r[0] for r in own)
                out[part, order, step] = [len(left), len(gone), fails - len(gone), sum(r[0] == {f} for r in own), sum(r[1] for r in gone), sum(r[2] for r in gone)]
                total[f] += len(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType()), T.StructField("n", T.StringType())])


def held(spark, rows, labels, parts=3):
    docs = documents(spark, [r[:2] for r in rows]).drop("lang")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang", T.StringType()), T.StructField("failed", T.LongType()), T.StructField("good", T.LongType())])
    own = spark.createDataFrame([(*d, r[2], 1, 1) for d, r in zip(docs.collect(), rows, strict=True)], schema).repartition(parts)
    got = M.audit(own, spark.createDataFrame([(*x, "n") for x in labels], LABELS))
    assert [f.dataType.typeName() for f in got.schema] == ["string", "string", "integer"] + ["long"] * 7
    found = {(r.part, r.filter_order, r.step): list(r)[3:] for r in got.collect()}
    assert found == plain(rows, labels)
    return found


def test_awkward_rows(spark):
    prose = " ".join(f"word{k}" for k in range(250))
    rows = [
        (1, prose, "en"), (2, prose, "en"), (2, prose, "en"), (3, prose + " #", "de"), (None, prose, "en"), (None, None, None), (4, None, None), (5, "", ""), (6, " \n\t", "en"), (7, "ABC DEF", "en"),
        (8, " ".join(["same"] * 300), "en"), (9, " ".join(["Same", "%"] * 150), "de"), (9, prose, "de"), (10, LONG, "en"), (11, LONG, "de"), (12, "é" * 97 + "ABC", "en"), (13, "é" * 96 + "ABC", "en"), (14, text(200, 3), "fr"), (15, prose.upper(), "en"),
        (16, "a\x0bb\x0cc d e\x00f", "en"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (3, None, 1), (3, 1, None), (9, 0, 1), (None, 1, 1), (99, 1, 1), (8, 1, 0), (8, 1, 0)]
    found = held(spark, rows, labels)
    assert len(found) == 4 * 600


def test_zeros_no_labels_and_no_rows(spark):
    prose = " ".join(f"word{k}" for k in range(250))
    found = held(spark, [(1, prose, "en")], [])
    assert set(map(tuple, found.values())) == {(1, 0, 0, 0, 0, 0, 0)}
    assert held(spark, [], [(1, 1, 1)]) == {}


def test_many_copies_of_one_text(spark):
    rows = [(k, "one text & all", "en" if k % 2 else None) for k in range(300)] + [(300 + k, f"text {k}", "en") for k in range(30)]
    held(spark, rows, [(k, 1, int(k % 3 == 0)) for k in range(0, 300, 7)], 8)


def test_long_texts_in_pieces():
    raw = LONG.encode()
    assert M.word_counts(raw, 1000) == M.word_counts(raw, 1 << 30) == (len(raw.split()), len(set(raw.split())))
    assert M.word_counts(b"x" * 5000, 100) == (1, 1) and M.word_counts(b" " * 500, 100) == (0, 0)
