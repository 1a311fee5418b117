"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as many of the longest length as fit, then the
binary digits of the rest from the largest down. Each piece is a sequence of its own in the bucket of its length, so a batch
drawn from one bucket needs no padding and no sequence crosses documents. There is no shuffle: every row is cut where it is
read, and the buckets are a column to partition a written table by.

Defined results: a null text counts as empty; an empty text yields the closing token alone; a null ``doc_id`` is kept as
null; repeated rows are packed each for itself; other columns of the input are neither read nor returned; an empty table
gives no rows. A very long text is tokenized in segments, cut only where the tokenizer begins a new piece anyway.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pieces
from .shared import groups_of, ragged, text_views, trimmed

CAPACITY = 2048
CLOSING = 1
#: Distinct pre-tokens that a Python worker keeps the ids of before it starts its table anew.
KEPT = 800_000
SEGMENT = 1 << 19

SCHEMA = "doc_id long, start long, length long, bucket int, doc_tokens long, ids binary"


class Encoder:
    """Ids of whole texts: the library encodes each distinct pre-token once, numpy strings the ids together.

    Byte-pair merging never crosses pre-tokens, so a text's ids are those of its pre-tokens in a row. Texts that hold an
    added token's string or an unassigned code point are given to the library whole."""

    def __init__(self, path: str, kept: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core, and threads have memory of their own
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.token_bytes = np.zeros(1 + max(vocabulary.values()), np.int64)  # a character of a byte-level token is a byte
        self.token_bytes[np.fromiter(vocabulary.values(), np.int64, len(vocabulary))] = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
        self.kept = kept
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes; arrays take a tenth of a dict's memory
        self.places = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 20, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens in a row, and how many each has: all go to the library as one split text, and the bytes that the
        ids stand for tell where a pre-token ends. Where they don't fit the pre-tokens, each is encoded for itself."""
        flat = np.array(self.library.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int64)
        ends = np.cumsum(pc.binary_length(pa.array(words, pa.string())).to_numpy().astype(np.int64))
        reached = np.cumsum(self.token_bytes[flat])
        at = np.searchsorted(reached, ends)
        if len(flat) and at[-1] == len(flat) - 1 and (reached[at] == ends).all():
            return flat.astype(np.uint32), np.diff(at, prepend=-1)
        encoded = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, encoded), np.int64, len(words))
        return np.fromiter((i for ids in encoded for i in ids), np.uint32, int(lengths.sum())), lengths

    def _learn(self, found: np.ndarray, words: list[str]) -> None:
        flat, lengths = self._encoded(words)
        n = len(self.known)
        while n + len(words) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[n : n + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n : n + len(words)] = lengths
        self.used += len(flat)
        at = np.searchsorted(self.known, found)
        self.known = np.insert(self.known, at, found)
        self.places = np.insert(self.places, at, np.arange(n, n + len(words), dtype=np.int32))

    def _known(self, found: np.ndarray) -> np.ndarray:
        """Table rows of hashes, -1 where there is none."""
        if not len(self.known):
            return np.full(len(found), -1)
        at = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
        return np.where(self.known[at] == found, self.places[at], -1).astype(np.int64)

    def _segment(self, text: str, codes: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts that begin at ``heads``, and how many each has. Texts at the same place are empty but the last."""
        starts, ends = pieces.byte_level(codes, np.unique(heads[heads < len(codes)]))
        hashed = pieces.hashes(codes, starts, ends)
        distinct, first, inverse = np.unique(hashed, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > self.kept:
            self._clear()
        at = self._known(distinct)
        new = np.flatnonzero(at < 0)
        if len(new):
            begun = len(self.known)
            self._learn(distinct[new], [text[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            at[new] = np.arange(begun, begun + len(new))
        at = at[inverse]
        lengths = self.lengths[at]
        ids = self.ids[ragged(self.starts[at], lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        bounds = total[np.searchsorted(starts, np.append(heads, len(codes)))]
        return ids, np.diff(bounds)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each text's ids."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        heads = np.cumsum([0, *map(len, texts)])[:-1]
        if any(s in joined for s in self.special) or len(codes) and pieces.classes()[codes].max() == pieces.UNKNOWN:
            if len(texts) > 1:
                halves = [self.encode(texts[: len(texts) // 2]), self.encode(texts[len(texts) // 2 :])]
                return tuple(np.concatenate(x) for x in zip(*halves, strict=True))
            ids = np.array(self.library.encode(texts[0], add_special_tokens=False).ids, np.uint32)
            return ids, np.array([len(ids)])
        if len(codes) <= 2 * SEGMENT:
            return self._segment(joined, codes, heads)
        parts = []
        bounds = [0, *pieces.safe_cuts(codes, SEGMENT), len(codes)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            parts.append(self._segment(joined[a:b], codes[a:b], np.zeros(1, np.int64))[0])
        ids = np.concatenate(parts)
        return ids, np.array([len(ids)])


def decomposed(tokens: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of so many tokens: the document, start and length of each piece."""
    top = capacity.bit_length() - 1
    full = tokens // capacity
    counts = np.concatenate([full[:, None], (tokens[:, None] >> np.arange(top - 1, -1, -1)) & 1], 1)
    sizes = np.broadcast_to(1 << np.arange(top, -1, -1), counts.shape)
    flat = counts.ravel()
    lengths = np.repeat(sizes.ravel(), flat)
    docs = np.repeat(np.repeat(np.arange(len(tokens)), top + 1), flat)
    begun = np.cumsum(lengths) - lengths
    first = np.cumsum(tokens) - tokens
    return docs, begun - first[docs], lengths


def _pack(path: str, capacity: int, closing: int):
    @trimmed
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("bucket", pa.int32()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in found:
            doc_ids = batch.column(0)
            _, offsets = text_views(batch.column(1))
            for i, j in groups_of(offsets, SEGMENT):
                texts = [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                ids, n = encoder.encode(texts)
                ends = np.cumsum(n)
                closed = np.insert(ids, ends, closing).astype("<u4")
                tokens = n + 1
                docs, start, length = decomposed(tokens, capacity)
                bounds = np.concatenate([[0], np.cumsum(length * 4)]).astype(np.int32)
                blobs = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(bounds), pa.py_buffer(closed)])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(docs + i)), pa.array(start), pa.array(length), pa.array((np.log2(length)).astype(np.int32)), pa.array(tokens[docs]), blobs], schema=schema
                )

    return run


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, closing: int = CLOSING) -> DataFrame:
    """One row per piece: ``doc_id, start, length, bucket`` (log2 of the length), ``doc_tokens, ids`` (little-endian unsigned
    32-bit), and ``sequence_id, offset`` of the sequence that the piece fills. ``capacity`` is a power of two."""
    if capacity & (capacity - 1) or capacity < 1:
        raise ValueError("capacity must be a power of two")
    cut = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_pack(tokenizer, capacity, closing), SCHEMA)
    return cut.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences as one Parquet folder per length."""
    packed.write.partitionBy("bucket").parquet(path)


def op1_pack_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens, with a digest of each piece's ids."""
    import public_tokenizers

    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
