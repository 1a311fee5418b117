"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a pre-token form a doubly linked list; a heap holds its adjacent pairs by merge rank. The lowest rank is popped,
stale entries are skipped, the two symbols are joined and the new neighbouring pairs are pushed. The count is the number of
initial symbols less the number of merges: no identifier is looked up. Each distinct pre-token is merged once per table of a
Python worker; numpy adds the counts of a text.

Defined results: a null text counts as empty (0 tokens); null ``doc_id`` stays null; every row is counted for itself, so
repeated rows repeat; other columns are not read; an empty table gives no rows. The string of an added token counts as one, and
what stands between such strings is counted for itself. Where a text holds a code point that this Python's Unicode tables leave
unassigned, the tokenizer library normalizes it and cuts it into pre-tokens by its own tables; these are merged here like all
others. A very long text is counted in segments, cut only where a pre-token ends anyway.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pieces
from .shared import groups_of, text_views, trimmed

LIMIT = 2048
KEPT = 1_000_000
SEGMENT = 1 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable bytes stand for themselves,
    the others follow from code point 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols are left of a pre-token when no adjacent pair can be merged."""
    n = len(symbols)
    get = ranks.get
    heap = [(r, i) for i in range(n - 1) if (r := get((symbols[i], symbols[i + 1]))) is not None]
    if not heap:
        return n
    heapq.heapify(heap)
    symbols = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pop, push, left = heapq.heappop, heapq.heappush, n
    while heap:
        rank, i = pop(heap)
        j = after[i]
        if j >= n or symbols[i] is None or get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        k = after[i] = after[j]
        left -= 1
        if k < n:
            before[k] = i
            if (r := get((symbols[i], symbols[k]))) is not None:
                push(heap, (r, i))
        h = before[i]
        if h >= 0 and (r := get((symbols[h], symbols[i]))) is not None:
            push(heap, (r, h))
    return left


class Counter:
    """Counts tokens as the library does for a word-end byte-pair vocabulary with a lower-casing normalizer."""

    def __init__(self, path: str, kept: int = KEPT):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path, self.suffix, self.kept = path, model["end_of_word_suffix"], kept
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {tuple(m): i for i, m in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cuts = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.symbols = byte_symbols()
        self.known: dict[int, int] = {}
        self._library = None

    def foreign(self, text: str) -> int:
        """The count of a text whose pre-tokens the library finds, by its newer Unicode tables; no identifier is asked for."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        found = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return sum(self._merged(list(piece)) for piece, _ in found)

    def word(self, piece: str) -> int:
        return self._merged([self.symbols[b] for b in piece.encode()])

    def _merged(self, symbols: list[str]) -> int:
        symbols[-1] += self.suffix
        return merged_length(symbols, self.ranks)

    @staticmethod
    def normalized(text: str) -> str:
        """NFC, then lower case by single characters (a sigma at a word's end is no exception)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _segment(self, text: str, codes: np.ndarray, heads: np.ndarray) -> np.ndarray:
        starts, ends = pieces.word_level(codes, np.unique(heads[heads < len(codes)]))
        if not len(starts):
            return np.zeros(len(heads), np.int64)
        hashed = pieces.hashes(codes, starts, ends)
        distinct, first, inverse = np.unique(hashed, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > self.kept:
            self.known = {}
        counts = np.fromiter((self.known.get(h, -1) for h in distinct.tolist()), np.int64, len(distinct))
        for i in np.flatnonzero(counts < 0).tolist():
            counts[i] = self.known[int(distinct[i])] = self.word(text[starts[first[i]] : ends[first[i]]])
        total = np.concatenate([[0], np.cumsum(counts[inverse])])
        return np.diff(total[np.searchsorted(starts, np.append(heads, len(codes)))])

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        raw = "".join(texts)
        parts = [self.cuts.split(t) for t in texts] if any(s in raw for s in self.special) else []
        if any(len(p) > 1 for p in parts):
            sizes = np.array([len(p) for p in parts])
            counts = self.count([p for own in parts for p in own])
            return np.add.reduceat(counts, np.cumsum(sizes) - sizes) + sizes - 1
        plain = [self.normalized(t) for t in texts]
        joined = "".join(plain)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(codes) and pieces.classes()[codes].max() == pieces.UNKNOWN:
            if len(texts) > 1:
                return np.concatenate([self.count(texts[: len(texts) // 2]), self.count(texts[len(texts) // 2 :])])
            return np.array([self.foreign(texts[0])])
        if len(codes) <= 2 * SEGMENT:
            return self._segment(joined, codes, np.cumsum([0, *map(len, plain)])[:-1])
        bounds = [0, *pieces.safe_cuts(codes, SEGMENT), len(codes)]
        return np.array([sum(int(self._segment(joined[a:b], codes[a:b], np.zeros(1, np.int64))[0]) for a, b in zip(bounds, bounds[1:], strict=False))])


def _count(path: str):
    @trimmed
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in found:
            _, offsets = text_views(batch.column(1))
            parts = [counter.count([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]) for i, j in groups_of(offsets, SEGMENT)]
            n = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(n.astype(np.int64))], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(documents: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_count(tokenizer), "doc_id long, n_bytes long, n_tokens long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, and whether they pass the context limit."""
    import public_tokenizers

    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
