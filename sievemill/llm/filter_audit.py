"""How five document filters interact, by inclusion-exclusion.

One pass over the texts gives each row its flags A to D and a digest of the text; rows of one id and text, then of one text, are
counted before they are shuffled, so a text that a third of the table repeats costs a row for each part and task. The smallest id
of a text settles flag E. Then nothing but joint-failure counts is gathered: for each of the 32 sets of filters the number of rows
that fail all of them, a sum of products of flags, for all rows, for those of good quality and for toxic ones. All that is
reported follows from these by Moebius inversion, for each part: survivors of any prefix of any order, rows that fail one filter
alone, redundant removals, and the Shapley value from the Harsanyi dividends of "removed by a set of filters".

Defined results: a null text is empty, and empty texts are identical to one another; an empty text fails A and no other of A to D;
a null ``doc_id`` is no smaller than any id and none is smaller than it, so such a row never fails E, and no label belongs to it;
rows that repeat id and text are the same document to E: none is a copy of another; repeated rows are each counted; an id that
has several labels is good or toxic if any of them says so; a null ``lang`` is the part of the empty string; texts of any length are read whole, a
long one in pieces that end at white space; an empty table gives no rows, as it has no part; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import operator
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import text_views, trimmed

FILTERS = "ABCDE"
WORDS = 200
SIGNS = b"#$%&*|"
#: Bytes of a text whose words are looked at one piece at a time.
SEGMENT = 1 << 22

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_WITHIN = bytes(range(0x80, 0xC0))
_MASKS = range(1 << len(FILTERS))


def word_counts(raw: bytes, segment: int = SEGMENT) -> tuple[int, int]:
    """How many words, and distinct words, a text in UTF-8 has."""
    if len(raw) <= segment:
        words = raw.split()
        return len(words), len(set(words))
    n, seen, at = 0, np.zeros(0, "S16"), 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + segment)
        end = cut.start() if cut else len(raw)
        words = raw[at:end].split()
        n += len(words)
        seen = np.union1d(seen, np.array([xxhash.xxh3_128_digest(w) for w in set(words)], "S16"))
        at = end
    return n, len(seen)


def failed(raw: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words, distinct = word_counts(raw)
    without = lambda some: len(raw.translate(None, some))
    capitals, points = len(raw) - without(_UPPER), without(_WITHIN)
    return (words < WORDS) | (100 * distinct < 50 * words) << 1 | (100 * capitals > 3 * points) << 2 | (without(SIGNS) < len(raw)) << 3


@trimmed
def _flags(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in found:
        data, offsets = text_views(batch.column(2))
        texts = (bytes(data[a:b]) for a, b in itertools.pairwise(offsets.tolist()))
        keys, flags = [], []
        for raw in texts:
            keys.append(hashlib.sha256(raw).digest())
            flags.append(failed(raw))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(flags, pa.int32())], names=["doc_id", "part", "text_key", "failed"])


def flags(documents: DataFrame) -> DataFrame:
    """``doc_id, part, text_key, failed`` of every row: the filters A to D that its text fails, as bits."""
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_flags, "doc_id long, part string, text_key binary, failed int")


def patterns(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, failed, good, toxic, n``: how many rows fail what, E included; a text, part and label may have several rows."""
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(*[F.max(F.coalesce(F.col(a) == 1, F.lit(False)).cast("int")).alias(b) for a, b in (("quality", "good"), ("toxic", "toxic"))])
    rows = flags(documents).groupBy("doc_id", "part", "text_key", "failed").agg(F.count("*").alias("n")).join(marks, "doc_id", "left")
    rows = rows.fillna(0, ["good", "toxic"])
    texts = rows.groupBy("text_key", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
    )
    own = F.col("first") == F.min("first").over(W.partitionBy("text_key"))  # a row for each part and label of a text
    texts = texts.withColumn("passed", F.col("no_id") + F.when(own, F.col("n_first")).otherwise(0))
    copies = 1 << FILTERS.index("E")
    both = F.array(F.struct(F.col("failed").alias("failed"), F.col("passed").alias("n")), F.struct(F.col("failed").bitwiseOR(F.lit(copies)).alias("failed"), (F.col("n") - F.col("passed")).alias("n")))
    return texts.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.failed", "x.n").filter("n > 0")


def joint_failures(found: DataFrame) -> DataFrame:
    """A row for each part, with the arrays ``of_all, of_good, of_toxic``: at the place of a set of filters, as bits, how many rows
    fail all of them. Each is a sum of products of flags; the empty set's is the number of rows."""
    flag = [F.getbit("failed", F.lit(i)).cast("long") for i in range(len(FILTERS))]
    weights = {"of_all": F.col("n"), "of_good": F.col("n") * F.col("good"), "of_toxic": F.col("n") * F.col("toxic")}
    product = lambda mask, n: functools.reduce(operator.mul, [f for i, f in enumerate(flag) if mask >> i & 1], n)
    sums = found.groupBy("part").agg(*[F.sum(product(m, n)).alias(f"{name}_{m}") for name, n in weights.items() for m in _MASKS])
    return sums.select("part", *[F.array(*[f"{name}_{m}" for m in _MASKS]).alias(name) for name in weights])


def _moebius(joint: str, factor: Callable[[Column], Column]) -> Column:
    """The sum over all sets of filters of the joint count, with a factor that depends on the set; longs."""
    return F.aggregate(_sets(), F.lit(0).cast("long"), lambda total, t: total + factor(t) * F.col(joint)[t])


def _sets() -> Column:
    return F.sequence(F.lit(0), F.lit(len(_MASKS) - 1))


def _sign(t: Column) -> Column:
    return 1 - 2 * (F.bit_count(t) % 2)


def _has(t: Column, i: Column) -> Column:
    return F.getbit(t, i).cast("int")


def survivors(joint: str) -> Column:
    """At the place of a set of filters, how many rows pass all of them: the alternating sum over its subsets."""
    return F.transform(_sets(), lambda s: _moebius(joint, lambda t: F.when(t.bitwiseAND(s) == t, _sign(t)).otherwise(0)))


def unique_failures(joint: str) -> Column:
    """For each filter, how many rows fail it and no other."""
    return F.transform(_places(), lambda i: _moebius(joint, lambda t: -_sign(t) * _has(t, i)))


def shapley(joint: str) -> Column:
    """For each filter its Shapley value times the number of orders. The dividend of a set in the game "rows that a set of filters
    removes" is its joint count with the sign of inclusion-exclusion; each member gets an equal share of it."""
    orders = math.factorial(len(FILTERS))
    equal = lambda t: F.floor(orders / F.greatest(F.bit_count(t), F.lit(1)))  # noqa: E731  divides without rest
    return F.transform(_places(), lambda i: _moebius(joint, lambda t: -_sign(t) * equal(t) * _has(t, i)))


def _places() -> Column:
    return F.sequence(F.lit(0), F.lit(len(FILTERS) - 1))


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` of every part, order and step."""
    known = joint_failures(patterns(documents, labels)).select(
        "part",
        F.array(*[F.col("of_all")[1 << i] for i in range(len(FILTERS))]).alias("fails"),
        *[survivors(f"of_{x}").alias(f"left_{x}") for x in ("all", "good", "toxic")],
        unique_failures("of_all").alias("unique"),
        shapley("of_all").alias("shapley"),
    )
    orders = F.split(F.lit(",".join(map("".join, itertools.permutations(FILTERS)))), ",")
    steps = known.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    place = lambda letter: F.ascii(letter) - ord("A")
    bits = F.transform(F.split("filter_order", ""), lambda x: F.array(*[F.lit(1 << i) for i in range(len(FILTERS))])[place(x)])
    done = lambda n: F.aggregate(F.slice(bits, F.lit(1), n), F.lit(0), lambda a, b: a + b)
    steps = steps.withColumns({"before": done(F.col("step") - 1), "after": done(F.col("step")), "own": place(F.substring("filter_order", F.col("step"), F.lit(1)))})
    lost = lambda x: F.col(x)[F.col("before")] - F.col(x)[F.col("after")]
    return steps.select(
        "part",
        "filter_order",
        "step",
        F.col("left_all")[F.col("after")].alias("kept"),
        lost("left_all").alias("removed"),
        (F.col("fails")[F.col("own")] - lost("left_all")).alias("redundant"),
        F.col("unique")[F.col("own")].alias("unique_fails"),
        lost("left_good").alias("good_lost"),
        lost("left_toxic").alias("toxic_lost"),
        F.col("shapley")[F.col("own")].alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the five filters does to ``documents``, in every order, for each language."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


#: The filters applied one after the other to the rows, in every order; no inclusion-exclusion.
OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), m AS (
  SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) THEN 16 ELSE 0 END AS fails
  FROM d LEFT JOIN m ON d.doc_id = m.doc_id
), p AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS own,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)::INT AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step) x
), r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN fails & (before | own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails & before = 0 AND fails & own > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails & before > 0 AND fails & own > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails & before = 0 AND fails & own > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails & before = 0 AND fails & own > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM p, s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
