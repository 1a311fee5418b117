"""Benchmark decontamination by spaced-seed hashing.

A seed mask looks at some of the token positions it spans and ignores the others, so a seed still matches where an ignored token
was substituted. Every placement of every mask on the benchmark items is hashed; training texts are hashed with the same masks
and joined to those hashes, first through a bit table, then by search in the sorted hashes. Around each hit the two token
sequences are compared along the hit's diagonal, and the longest stretch in which at most a fifth of the tokens differ is the
overlap. A document leaks an item if the overlap spans LEAST tokens, or the whole item where that is shorter. Every such stretch
has five tokens in a row of which at most one differs, and so a seed: the masks cover each place of that one.

Where a text and an item repeat themselves, hits are many more than diagonals: such a pair, told by counting equal seeds without
listing their hits, is compared along all its diagonals, those that may hold the longest overlap first. So time and memory follow
the lengths of both and not the product of repetitions.

The benchmark is a stated query set: it is read in blocks of at most BLOCK_TOKENS tokens, each sent to one pass over the documents,
so what is sent is bounded however large the benchmark is; with more than one block, each pass is written before the next. There
is no shuffle, and a passage that very many documents share costs each of them its own comparison only.

Tokens are runs of letters and digits in lower case. Defined results: null and empty texts leak nothing; items of fewer than
SHORTEST tokens leak where they stand word for word; repeated items or rows are each reported; null ids come back as null;
empty tables give no leaks; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pieces
from .ngrams import Words
from .shared import exists, groups_of, new_path, ragged, remove, text_views, trimmed, written

#: 1: the token counts; 0: any token.
MASKS = ("1111", "10111", "11011", "11101", "1", "11", "111")
#: Shorter masks are for items of just their length.
SPAN = 4
LEAST = 13
SHORTEST = 5
#: What a differing token costs against a matching one: 4 admits one in five.
COST = 4
BLOCK_TOKENS = 1_000_000
TABLE_BITS = 22
SEGMENT = 1 << 18
#: Hits of a text and an item for each of their tokens from which all diagonals are compared instead.
REPEATED = 4
#: Hits that are listed at once, and cells of diagonals that are compared at once.
HITS, CELLS = 1 << 18, 1 << 18

_OFFSETS = [np.flatnonzero([c == "1" for c in m]) for m in MASKS]
_FACTORS = np.random.default_rng(6).integers(0, 1 << 63, (len(MASKS), 16), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of texts in a row, and how many come before each text."""
    words = Words(texts, numbers=True)
    if not words.count:
        return np.zeros(0, np.uint64), words.bounds
    blanks = np.flatnonzero(words.codes == 0x20)
    return pieces.hashes(words.codes, blanks[:-1] + 1, blanks[1:]), words.bounds


def seeds(found: np.ndarray, bounds: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each placement of a mask within a text."""
    span = len(MASKS[mask])
    m = len(found) - span + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(m, np.uint64)
    for k, off in enumerate(_OFFSETS[mask]):
        h += (found[off : off + m] ^ (found[off : off + m] >> np.uint64(31))) * _FACTORS[mask, k]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    n = np.diff(bounds)
    at = ragged(bounds[:-1], np.maximum(n - span + 1, 0))
    return h[at], at


@dataclass
class Block:
    """Some items: their tokens and the sorted hashes of their seeds."""

    items: list[tuple[int | None, np.ndarray]]

    def __post_init__(self) -> None:
        found = np.concatenate([t for _, t in self.items])
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for _, t in self.items])])
        self.found = found
        own = []
        for k in range(len(MASKS)):
            h, at = seeds(found, self.bounds, k)
            if len(MASKS[k]) < SPAN:
                whole = np.diff(self.bounds)[np.searchsorted(self.bounds, at, "right") - 1] == len(MASKS[k])
                h, at = h[whole], at[whole]
            own.append((h, at))
        self.masks = [k for k, (h, _) in enumerate(own) if len(h)]
        h, at = np.concatenate([x for x, _ in own]), np.concatenate([x for _, x in own])
        order = np.argsort(h, kind="stable")
        self.hashes, self.places = h[order], at[order]
        #: each distinct hash, and its places in each item that has it
        self.distinct, first = np.unique(self.hashes, return_index=True)
        self.bounds_of = np.append(first, len(self.hashes))
        self.item_of = np.searchsorted(self.bounds, self.places, "right") - 1
        changes = np.ones(len(self.hashes), bool)
        changes[1:] = (self.hashes[1:] != self.hashes[:-1]) | (self.item_of[1:] != self.item_of[:-1])
        self.groups = np.flatnonzero(changes)  # places of one hash lie in order, so items do too
        self.group_size = np.diff(np.append(self.groups, len(self.hashes)))
        self.groups_of = np.searchsorted(self.groups, self.bounds_of)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.hashes >> np.uint64(64 - TABLE_BITS)] = True

    def _hits(self, found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the texts whose seed the block has, and the number of that seed."""
        places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for mask in self.masks:
            h, at = seeds(found, bounds, mask)
            hit = self.table[h >> np.uint64(64 - TABLE_BITS)]
            h, at = h[hit], at[hit]
            k = np.minimum(np.searchsorted(self.distinct, h), len(self.distinct) - 1)
            equal = self.distinct[k] == h
            places.append(at[equal])
            numbers.append(k[equal])
        return np.concatenate(places), np.concatenate(numbers)

    def _diagonals(self, found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of text, item and shift of the diagonals that have a seed; and of text and item where all have to be compared."""
        places, numbers = self._hits(found, bounds)
        text = np.searchsorted(bounds, places, "right") - 1
        order = np.lexsort((places, numbers, text))
        text, numbers, places = text[order], numbers[order], places[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (numbers[1:] != numbers[:-1])
        start = np.flatnonzero(new)
        times = np.diff(np.append(start, len(text)))
        # one row for each seed that a text and an item share, however often
        own, seed = text[start], numbers[start]
        n_groups = self.groups_of[seed + 1] - self.groups_of[seed]
        group = ragged(self.groups_of[seed], n_groups)
        row = np.repeat(np.arange(len(start)), n_groups)
        item = self.item_of[self.groups[group]]
        pair = own[row] * len(self.items) + item
        pairs, of_pair = np.unique(pair, return_inverse=True)
        t, i = pairs // max(1, len(self.items)), pairs % max(1, len(self.items))
        sizes = np.diff(bounds)[t] + np.diff(self.bounds)[i]
        many = np.bincount(of_pair, times[row] * self.group_size[group], len(pairs)) > REPEATED * sizes
        keep = ~many[of_pair]
        row, group = row[keep], group[keep]
        # the hits of the other pairs: each of the text's places with each of the item's, some at a time
        n = times[row] * self.group_size[group]
        cuts = np.searchsorted(np.cumsum(n), np.arange(HITS, n.sum() + HITS, HITS), "right") + 1 if len(n) else []
        out, a = [np.zeros((0, 3), np.int64)], 0
        for b in cuts:
            r, g = row[a:b], group[a:b]
            a = max(a, b)
            size = self.group_size[g]
            left = ragged(start[r], times[r])
            size_of = np.repeat(size, times[r])
            left, right = np.repeat(left, size_of), ragged(np.repeat(self.groups[g], times[r]), size_of)
            out.append(np.unique(np.stack([text[left], self.item_of[right], places[left] - self.places[right]], 1), axis=0))
        return np.unique(np.concatenate(out), axis=0), np.stack([t[many], i[many]], 1)

    def _longest(self, own: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int]:
        """First token in the text, tokens and matching tokens of the longest overlap on these diagonals, of equal ones that of the
        least shift; no tokens if none is long enough. A shift is the text's place less the item's."""
        whole = len(item)
        least = min(LEAST, whole)
        shifts = shifts[np.minimum(whole, len(own) - shifts) - np.maximum(0, -shifts) >= least]
        rows = max(1, CELLS // whole)
        places = np.arange(whole)

        def equal(some: np.ndarray) -> np.ndarray:
            at = some[:, None] + places
            inside = (at >= 0) & (at < len(own))
            return (own[np.where(inside, at, 0)] == item) & inside

        bound = np.concatenate([np.zeros(0, np.int64), *(equal(shifts[i : i + rows]).sum(1) for i in range(0, len(shifts), rows))])
        # at most a fifth of a stretch differs
        bound = np.minimum(bound * (COST + 1) // COST, np.minimum(whole, len(own) - shifts) - np.maximum(0, -shifts))
        order = np.lexsort((shifts, -bound))
        shifts, bound = shifts[order], bound[order]
        best, at, begin, matching = 0, 0, 0, 0
        i, step = 0, 1
        while i < len(shifts) and bound[i] >= least and (bound[i], at) > (best, shifts[i] if bound[i] == best else at - 1):
            some = shifts[i : i + step]
            same = equal(some)
            inside = (some[:, None] + places >= 0) & (some[:, None] + places < len(own))
            # what lies outside the text ends a stretch
            run = np.concatenate([np.zeros((len(some), 1), np.int64), np.cumsum(np.where(same, 1, np.where(inside, -COST, -COST * 2 * (whole + 1))), 1)], 1)
            # for each end the first start from which the run does not fall, in all rows at once
            low = -np.minimum.accumulate(run, 1)
            gap = int(low.max() + np.abs(run).max()) + 1
            lift = (np.arange(len(some)) * 2 * gap)[:, None]
            starts = np.searchsorted((low + lift).ravel(), (-run + lift).ravel(), "left").reshape(run.shape) - (np.arange(len(some)) * (whole + 1))[:, None]
            lengths = np.arange(whole + 1) - starts
            stop = lengths.argmax(1)
            long = lengths[np.arange(len(some)), stop]
            for k in np.flatnonzero(long >= max(best, least)).tolist():
                if long[k] > best or some[k] < at:
                    s, e = int(starts[k, stop[k]]), int(stop[k])
                    best, at, begin, matching = int(long[k]), int(some[k]), int(some[k]) + s, int(same[k, s:e].sum())
            i += step
            step = min(2 * step, rows)
        return begin, best, matching

    def overlaps(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """The best overlap of each text and item that leaks: text, item, first token in the text, tokens, matching tokens."""
        found, bounds = tokens(texts)
        diagonals, repeated = self._diagonals(found, bounds)
        todo = []
        if len(diagonals):
            head = np.flatnonzero(np.concatenate([[True], (diagonals[1:, :2] != diagonals[:-1, :2]).any(1)]))
            for s, e in zip(head.tolist(), [*head[1:].tolist(), len(diagonals)], strict=True):
                t, i = diagonals[s, :2].tolist()
                # of places in the row of texts and of items
                todo.append((t, i, diagonals[s:e, 2] - int(bounds[t]) + int(self.bounds[i])))
        todo += [(t, i, np.arange(-int(self.bounds[i + 1] - self.bounds[i]) + 1, int(bounds[t + 1] - bounds[t]))) for t, i in repeated.tolist()]
        out = []
        for t, i, shifts in todo:
            start, length, matching = self._longest(found[bounds[t] : bounds[t + 1]], self.found[self.bounds[i] : self.bounds[i + 1]], shifts)
            if length:
                out.append((t, i, start, length, matching))
        return sorted(out)


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The items, a bounded number of tokens at a time."""
    items, n = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        found = tokens([row.text or ""])[0]
        if len(found):
            items.append((row.item_id, found))
            n += len(found)
        if n >= BLOCK_TOKENS:
            yield Block(items)
            items, n = [], 0
    if items:
        yield Block(items)


def _leaks(block: Block):
    @trimmed
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            _, offsets = text_views(batch.column(1))
            for i, j in groups_of(offsets, SEGMENT):
                hits = block.overlaps([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()])
                if hits:
                    ids = batch.column(0).slice(i, j - i).take(pa.array([h[0] for h in hits], pa.int64()))
                    rest = [pa.array([h[k] for h in hits], pa.int64()) for k in (2, 3, 4)]
                    yield pa.RecordBatch.from_arrays([ids, pa.array([block.items[h[1]][0] for h in hits], pa.int64()), *rest], names=["doc_id", "item_id", "start", "length", "matching"])

    return run


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, length, matching``: every document and benchmark item that overlap, with the best overlap's
    first token in the document, its tokens and how many of them are equal."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, start long, length long, matching long"
    path, waiting = new_path(spark, "leaks"), None
    for block in blocks(benchmark):
        if waiting is not None:
            waiting.write.mode("append").parquet(path)
        waiting = docs.mapInArrow(_leaks(block), schema)
    if waiting is None:
        return spark.createDataFrame([], schema)
    # with one block nothing has to be written, and of several the last need not be
    return spark.read.schema(schema).parquet(path).union(waiting) if exists(spark, path) else waiting


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` less those that leak a benchmark item, columns unchanged."""
    out, path = documents, None
    for k, block in enumerate(blocks(benchmark)):
        if k:
            earlier = path
            out, path = written(out, "clean")
            if earlier:
                remove(documents.sparkSession, earlier)

        @trimmed
        def keep(found: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in found:
                column = batch.column(batch.schema.get_field_index("text"))
                clean = np.ones(len(batch), bool)
                _, offsets = text_views(column)
                for i, j in groups_of(offsets, SEGMENT):
                    for hit in block.overlaps([t or "" for t in column.slice(i, j - i).to_pylist()]):
                        clean[i + hit[0]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(keep, T.StructType(documents.schema.fields))
    return out


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak of a benchmark item in a document."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
