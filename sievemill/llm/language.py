"""Language identification by mixture inference.

Each language has a smoothed distribution over character n-grams, counted over all labelled documents of the training folds.
The likelihood of a word under a language is the product over its n-grams; a document is a mixture of languages, whose
proportions expectation-maximisation estimates over its words. Languages are then eliminated backwards: the least one goes
as long as the likelihood, less a penalty of half a log of the word count for each language, does not fall. The prediction is
the largest language of the set that is left, its proportion the score.

Defined results: a null text, or one without a letter, is ``und`` with score 0; rows with null ``lang`` teach nothing; with no
labelled row at all everything is ``und``; null ``doc_id`` counts as not held out; repeated rows are judged each for itself; of languages with
equal proportions the first by name is predicted; a very long text is judged whole, its n-grams taken in pieces that end between
words; an empty table gives no rows; added columns never clash, their names are given by the caller. The model holds languages x buckets numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ngrams import Words, cut
from .shared import groups_of, text_views, trimmed
from .toxicity import append_column, held_out

GRAM = 3
BITS = 15
SMOOTHING = 0.5
ROUNDS = 8
SEGMENT = 1 << 18
UNDETERMINED = "und"


@trimmed
def _counts(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of each language in a partition."""
    sums: dict[str, np.ndarray] = {}
    for batch in found:
        langs = batch.column(1).to_pylist()
        _, offsets = text_views(batch.column(0))
        for i, j in groups_of(offsets, SEGMENT):
            texts = [t or "" for t in batch.column(0).slice(i, j - i).to_pylist()]
            if j - i == 1 and len(texts[0]) > 2 * SEGMENT:
                for piece in cut(texts[0].lower(), SEGMENT):
                    bucket, _ = Words([piece]).grams(GRAM, BITS)
                    sums[str(langs[i])] = sums.get(str(langs[i]), 0) + np.bincount(bucket, minlength=1 << BITS)
                continue
            words = Words(texts)
            bucket, word = words.grams(GRAM, BITS)
            own, codes = np.unique(np.array(langs[i:j], object).astype(str), return_inverse=True)
            lang = np.repeat(codes, np.diff(words.bounds))[word] if words.count else np.zeros(0, np.int64)
            counts = np.bincount(lang * (1 << BITS) + bucket, minlength=len(own) << BITS).reshape(len(own), -1)
            for k, name in enumerate(own):
                sums[name] = sums.get(name, 0) + counts[k]
    for name, counts in sums.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))], names=["lang", "bucket", "n"])


@dataclass
class Model:
    names: list[str]
    log_p: np.ndarray  # buckets x languages

    def _log_like(self, words: Words) -> np.ndarray:
        """Log likelihood of each word under each language."""
        bucket, word = words.grams(GRAM, BITS)
        found = [np.bincount(word, self.log_p[bucket, k], words.count) for k in range(len(self.names))]
        return np.stack(found, 1) if found else np.zeros((words.count, 0))

    def _read(self, texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
        """The same of all texts' words in a row, and the words before each text and the end."""
        if len(texts) == 1 and len(texts[0]) > 2 * size:
            found = np.concatenate([self._log_like(Words([piece])) for piece in cut(texts[0].lower(), size)])
            return found, np.array([0, len(found)])
        words = Words(texts)
        return self._log_like(words), words.bounds

    def proportions(self, texts: list[str], size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
        """Each text's proportions over the languages of its chosen set, and whether it has a word."""
        log_like, bounds = self._read(texts, size)
        n_lang, n_text = len(self.names), len(texts)
        n_words = np.diff(bounds)
        some = np.flatnonzero(n_words)
        out = np.zeros((n_text, n_lang))
        if not len(some) or not n_lang:
            return out, n_words > 0
        log_like -= log_like.max(1, keepdims=True)
        like = np.maximum(np.exp(log_like, out=log_like), 1e-12)
        starts = bounds[:-1][some]
        doc = np.repeat(np.arange(len(some)), n_words[some])
        size = n_words[some][:, None].astype(float)

        def infer(share: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
            share = np.where(allowed, np.maximum(share, 1e-3), 0)
            share /= share.sum(1, keepdims=True)
            for _ in range(rounds):
                mixed = like * share[doc]
                share = np.add.reduceat(mixed / mixed.sum(1, keepdims=True), starts) / size
            total = np.add.reduceat(np.log((like * share[doc]).sum(1)), starts)
            return share, total - 0.5 * np.log(size[:, 0] + 1) * allowed.sum(1)

        allowed = np.ones((len(some), n_lang), bool)
        share, value = infer(np.full((len(some), n_lang), 1 / n_lang), allowed, ROUNDS)
        going = np.arange(len(some))
        for _ in range(n_lang - 1):
            fewer = allowed.copy()
            least = np.where(allowed, share, np.inf).argmin(1)
            fewer[np.arange(len(some)), least] = False
            stop = np.ones(len(some), bool)
            stop[going] = False
            fewer[stop] = allowed[stop]
            new_share, new_value = infer(share, fewer, ROUNDS // 2)
            better = (new_value >= value) & ~stop
            share[better], value[better], allowed[better] = new_share[better], new_value[better], fewer[better]
            going = np.flatnonzero(better)
            if not len(going):
                break
        out[some] = share
        return out, n_words > 0

    def predict(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        share, lettered = self.proportions(texts)
        if not self.names:
            return pa.array([UNDETERMINED] * len(texts)), np.zeros(len(texts))
        best = share.argmax(1)
        names = [self.names[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        return pa.array(names, pa.string()), np.where(lettered, np.minimum(share[np.arange(len(texts)), best], 1.0), 0.0)


def train(documents: DataFrame) -> Model:
    """Count n-grams of every labelled row outside the held-out fold."""
    known = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counted = known.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(_counts, "lang string, bucket int, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs, buckets, n = rows.column(0).to_pylist(), rows.column(1).to_numpy(), rows.column(2).to_numpy()
    names = sorted(set(langs))
    counts = np.full((1 << BITS, len(names)), SMOOTHING)
    if names:
        counts[buckets, np.searchsorted(np.array(names), np.array(langs))] += n
    return Model(names, np.log(counts / counts.sum(0)).astype(np.float32))


def identify(documents: DataFrame, model: Model, name: str = "lang_pred", score: str = "score") -> DataFrame:
    """``documents`` with the predicted language and its proportion in the text."""
    if {name.lower(), score.lower()} & {c.lower() for c in documents.columns}:
        raise ValueError(f"columns {name} or {score} are there already")
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())])
    return documents.mapInArrow(lambda found: append_column(found, "text", [name, score], model.predict), schema)


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's main language, from n-grams of the labelled documents outside the held-out fold."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(documents.select("doc_id", "text", "lang"))
    found = identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
