"""Toxicity: bags of subword embeddings averaged into a linear softmax, embeddings and softmax trained jointly in numpy.

A word's subwords are its character n-grams with its edges, hashed into one table, so that an unseen misspelling shares the
vectors of the n-grams that it keeps. A text is read in half-overlapping windows of words; the embeddings of a window's
n-grams are averaged and given to the softmax, and a text's score is that of its most toxic window: a long text is not
diluted by its clean parts. Training is on labelled texts, first on averages of whole texts, then on each text's highest
window. At scoring the product of embeddings and softmax is one number per n-gram.

The labelled sample that the driver fits on is bounded by ``PER_CLASS`` and ``SAMPLE_BYTES``; every row is scored.

Defined results: a null or empty text, or one without letters or digits, has the score of the bias alone; null ``doc_id``
counts as not held out; repeated rows are scored each for itself; labels that are null, repeated for one id (the highest
counts) or without a document are harmless; of an id's several texts the smallest is learned from; without labels of both classes
every score is the share of toxic labels (0 if none); a very long text is scored whole, in pieces that end between words; an empty
table gives no rows. Added columns never clash: their names are given by the caller.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ngrams import Words, cut
from .shared import give_back, groups_of, text_views, trimmed

GRAMS = (3, 4, 5, 6)
BITS = 16
DIMENSIONS = 8
HALF = 6
#: N-grams that a window counts as having at least: a window of few words tells little.
FULL = 60
#: Bounds of the labelled sample: texts of each class, and the longest text's bytes.
PER_CLASS = 1500
SAMPLE_BYTES = 8192
THRESHOLD = 0.3
#: Bytes of texts that are worked on at once: n-grams take some hundred times their memory.
SEGMENT = 1 << 18


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram buckets in the order of their blocks, each one's block, and each text's first block. A block has HALF words, each
    word of a text counting where it stands first; a text without words has one empty block."""
    words = Words(texts, numbers=True)
    first_ones = words.first_of_each()
    before = np.concatenate([[0], np.cumsum(first_ones)])
    bounds = before[words.bounds]
    n_blocks = np.maximum(1, -(-np.diff(bounds) // HALF))
    first = np.concatenate([[0], np.cumsum(n_blocks)])
    doc = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
    block = first[doc] + (before[:-1] - bounds[doc]) // HALF
    found = [words.grams(n, BITS) for n in GRAMS]
    bucket, at = np.concatenate([b for b, _ in found]).astype(np.int64), np.concatenate([w for _, w in found])
    if not words.count:
        return bucket, at, first
    keep = first_ones[at]
    return bucket[keep], block[at[keep]], first


def windows(sums: np.ndarray, counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of each block together with the next of the same text."""
    together, n = sums.copy(), counts.astype(np.float64)
    joins = np.ones(len(counts), bool)
    joins[first[1:] - 1] = False
    at = np.flatnonzero(joins)
    together[at] += sums[at + 1]
    n[at] += counts[at + 1]
    n = np.maximum(n, FULL)
    return together / (n[:, None] if together.ndim == 2 else n)


@dataclass
class Model:
    """One number per n-gram bucket, and the bias: the softmax's logit is their mean plus the bias."""

    weights: np.ndarray
    bias: float

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum of weights and number of n-grams of each block, and each text's first block."""
        bucket, at, first = bags(texts)
        n = int(first[-1])
        return np.bincount(at, self.weights[bucket], n), np.bincount(at, minlength=n), first

    def sums_of_long(self, text: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of one text, a piece at a time; what is kept of a piece is the hashes of its words and its blocks' sums."""
        seen, done = np.zeros(0, np.uint64), 0
        sums, counts = np.zeros(1), np.zeros(1, np.int64)
        for piece in cut(text.lower(), size):
            words = Words([piece], numbers=True)
            hashed = words.hashes()
            new, places = np.unique(hashed, return_index=True)
            at = np.searchsorted(seen, new)
            known = np.zeros(len(new), bool)
            known[at < len(seen)] = seen[at[at < len(seen)]] == new[at < len(seen)]
            first = np.zeros(words.count, bool)
            first[places[~known]] = True
            seen = np.insert(seen, at[~known], new[~known])
            block = (done + np.cumsum(first) - first) // HALF
            done += int(first.sum())
            more = max(1, -(-done // HALF)) - len(sums)
            sums, counts = np.append(sums, np.zeros(more)), np.append(counts, np.zeros(more, np.int64))
            for n in GRAMS:
                bucket, word = words.grams(n, BITS)
                own = block[word[first[word]]]
                sums += np.bincount(own, self.weights[bucket[first[word]]], len(sums))
                counts += np.bincount(own, minlength=len(sums))
        return sums, counts, np.array([0, len(sums)])

    def scores(self, texts: list[str], size: int = SEGMENT) -> np.ndarray:
        long = len(texts) == 1 and len(texts[0]) > 2 * size
        sums, counts, first = self.sums_of_long(texts[0], size) if long else self.sums(texts)
        best = np.maximum.reduceat(windows(sums, counts, first), first[:-1])
        return 1 / (1 + np.exp(-np.clip(best + self.bias, -30, 30)))


def narrow(bucket: np.ndarray, block: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same in six bytes an n-gram: those of all texts of the sample lie in the driver beside its JVM."""
    return bucket.astype(np.uint16), block.astype(np.int32), first


def fit(texts: list[str], toxic: np.ndarray, share: float, epochs: int = 30, seed: int = 7) -> Model:
    """Embeddings (buckets x DIMENSIONS) and a two-class softmax by minibatch Adagrad. ``share``: of toxic rows among all
    labelled ones; the loss weighs the classes to it."""
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    table = rng.normal(0, 0.1, (size, DIMENSIONS))
    soft = rng.normal(0, 0.5, (DIMENSIONS, 2))
    bias = np.array([np.log(1 - share), np.log(share)])
    past = [np.full_like(table, 1e-4), np.full_like(soft, 1e-2), np.full_like(bias, 1e-1)]
    y = toxic.astype(np.int64)
    own = max(y.mean(), 1e-9)
    weight = np.where(y == 1, share / own, (1 - share) / max(1 - own, 1e-9))
    weight *= np.where(y == 1, 3.0, 1.0) / weight.mean()
    chunks = [narrow(*bags([t])) for t in texts]
    for epoch in range(epochs):
        for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 64)):
            own_blocks = [int(chunks[i][2][-1]) for i in part]
            base = np.concatenate([[0], np.cumsum(own_blocks)])
            bucket = np.concatenate([chunks[i][0] for i in part])
            at = np.concatenate([chunks[i][1] + b for i, b in zip(part, base, strict=False)])
            n = int(base[-1])
            counts = np.bincount(at, minlength=n)
            if epoch < 3:  # whole texts
                doc = np.repeat(np.arange(len(part)), own_blocks)
                bag, bag_count = doc[at], np.maximum(np.bincount(doc[at], minlength=len(part)), FULL)
                use = slice(None)
            else:
                flat = np.bincount(at, (table @ (soft[:, 1] - soft[:, 0]))[bucket], n)
                score = windows(flat, counts, base)
                top = np.array([b + int(np.argmax(score[b:e])) for b, e in zip(base, base[1:], strict=False)])
                bag_of = np.full(n + 1, -1)
                bag_of[top] = np.arange(len(part))
                follows = (top + 1 < base[1:])
                bag_of[top[follows] + 1] = np.flatnonzero(follows)
                bag = bag_of[at]
                use = bag >= 0
                bag = bag[use]
                bag_count = np.maximum(np.bincount(bag, minlength=len(part)), FULL)
            grams = bucket[use]
            mean = np.stack([np.bincount(bag, table[:, d][grams], len(part)) for d in range(DIMENSIONS)], 1) / bag_count[:, None]
            logits = mean @ soft + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p *= weight[part][:, None] / len(part)
            back = (p @ soft.T) / bag_count[:, None]
            steps = [np.stack([np.bincount(grams, back[bag, d], size) for d in range(DIMENSIONS)], 1), mean.T @ p, p.sum(0)]
            for value, step, sums, rate in zip((table, soft, bias), steps, past, (0.3, 0.1, 0.05), strict=True):
                sums += step * step
                value -= rate * step / np.sqrt(sums)
    return Model((table @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold, taken by a hash of the id from those whose text is
    there and within SAMPLE_BYTES."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    n, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter((F.octet_length("text") <= SAMPLE_BYTES) & (F.octet_length("text") > 0))
    usable = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    picks = [r for c in (0, 1) for r in usable.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS).collect()]
    label: dict[int, int] = {}
    for r in picks:
        label[r.doc_id] = max(r.toxic, label.get(r.doc_id, 0))
    if not label or len(set(label.values())) < 2:
        share = n_toxic / n if n else 0.0
        return Model(np.zeros(1 << BITS, np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    chosen = documents.sparkSession.createDataFrame([(i,) for i in sorted(label)], "doc_id long")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id", "left_semi")  # at most 2 * PER_CLASS ids
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: r.doc_id)
    toxic = np.array([label[r.doc_id] for r in rows])
    if len(set(toxic.tolist())) < 2:
        share = n_toxic / n
        return Model(np.zeros(1 << BITS, np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    model = fit([r.text for r in rows], toxic, n_toxic / n)
    give_back()  # the driver lives on, and later stages plan beside what this one took
    return model


@trimmed
def append_column(found: Iterator[pa.RecordBatch], text: str, names: list[str], compute) -> Iterator[pa.RecordBatch]:
    """Each batch with the columns that ``compute(texts)`` gives, texts taken in groups of bounded size."""
    for batch in found:
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = text_views(column)
        parts = [compute([t or "" for t in column.slice(i, j - i).to_pylist()]) for i, j in groups_of(offsets, SEGMENT)]
        new = [pa.concat_arrays([pa.array(p[k]) for p in parts]) if parts else None for k in range(len(names))]
        if parts:
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])


def score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``documents`` with the column ``name``: the chance of label 1 from the whole text."""
    clash = {c.lower() for c in documents.columns}
    if name.lower() in clash:
        raise ValueError(f"column {name} is there already")
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())])
    return documents.mapInArrow(lambda found: append_column(found, "text", [name], lambda texts: [model.scores(texts).astype(np.float64)]), schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, from a model of the labels outside the held-out fold."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(documents, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
