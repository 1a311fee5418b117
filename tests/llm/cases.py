"""Awkward rows that every operator has to get through."""

from pathlib import Path

from pyspark.sql import types as T

from sievemill.llm.shared import shared_dir

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()), T.StructField("component_id", T.StringType())])
WORDS = "and the of nd ing er th on re at en ou ha it st is ed or ti hi as to".split()


def text(n, seed=0):
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("".join(WORDS[(x >> s) % len(WORDS)] for s in (4, 9, 15)[: 1 + x % 3]))
    return " ".join(out)


LONG = text(60_000, 5)
TEXTS = [
    (1, text(80, 1)), (2, text(80, 1)), (3, text(80, 1).upper()), (4, text(80, 1) + " extra"), (5, None), (6, ""), (7, "  \n\t "), (8, "one two"), (9, "One  TWO"), (10, LONG),
    (11, LONG + " tail"), (12, text(40, 2)), (12, text(40, 2)), (None, text(80, 1)), (13, "日本語 テキスト é ñ ß İ K"), (14, "don't 's a<|endoftext|>b 12 3½"), (15, "!!! ???"), (16, text(300, 3) + "\nReleased under the MIT License.\n" + text(30, 4)),
    (17, "͸ unassigned"), (18, "a\x00b\x85c"),
]


def documents(spark, rows=None):
    rows = TEXTS if rows is None else rows
    return spark.createDataFrame([(i, t, "en" if i and i % 2 else None, "s", len(t) if t else None, "x", "y") for i, t in rows], SCHEMA)


def written_tables(spark):
    """Paths of the intermediate tables that are there."""
    return set(Path(shared_dir(spark).removeprefix("file://")).glob("sievemill-*/*"))
