"""Near-duplicates by a MinHash LSH forest.

A document's set is that of its distinct 5-word shingles. Equal sets are one class, found by a digest and aggregated before
anything else, so a large group of copies costs one row. Each class's signature gives TREES sorted orders: a tree orders the
classes by DEPTH of the minimum hashes, then by id, and a class's candidates are its WINDOW neighbours on either side that share
at least the first value. Those are the rows of the longest common prefix: where the order is crowded a candidate has to agree to
a great depth, where it is sparse the first value is enough. Orders are range-partitioned by prefix and id, so even rows of equal
prefixes are spread over tasks; rows at the partitions' edges are compared in a small pass of their own. Set sizes and a sketch of
two bits a hash drop candidates far from the threshold; all others are confirmed on the full sets of the texts. Each class first
confirms its FIRST most similar candidates; of the rest only those that still lie in different components, so a large group of
near copies does not confirm all that it has in its windows. Components of the confirmed links follow by minimum labels.

A run of classes that share a tree's first value and is longer than the window is crowded: some of its pairs have not met. In a
run of at most REGION classes every pair whose components differ is compared by a wider sketch. In a longer one the reach adapts to the
depth that classes share: in its sorted order each class is compared with the REGION next to it at least, those of the longest
common prefix; and classes with SATURATED links or more, whose windows may have been too small for all that they resemble, are
compared with the whole run. What is proposed goes to confirmation most similar first: each class outside its group's largest
component proposes its ASKED most similar classes, the links found join components, and the last round proposes all that are left.

Every step grows with the classes: windows with TREES x WINDOW, crowded runs with TREES x 2 x REGION at most, and with the
saturated classes of a run. Candidates are found by hashing, so a link may be missed by chance: two sets at the threshold share a
first value in none of TREES trees with probability 0.25 ** TREES; in a run beyond REGION they have to share a prefix that fewer
than REGION others share.

Defined results: null and empty texts, and texts of white space, have the empty set, link with nothing and are kept; a text of
fewer than five words has its whole sequence as its one shingle; a null ``doc_id`` takes no part: its row has a null
``component_id`` and is kept; repeated rows each come back; texts that share an id are one document, in one component with all
that any of them is linked with; other columns are not read; an empty table gives no rows. The result does not depend on how the
rows are partitioned.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.operators.chunk import global_positions
from sievemill.operators.components import connected_components

from .shared import groups_of, only, remove, text_views, trimmed, written

SHINGLE = 5
THRESHOLD = 75
TREES = 16
DEPTH = 8
WINDOW = 4
#: Candidates that each class confirms before components are known, the most similar first.
FIRST = 3
#: Candidates of a class in a crowded run by round, the most similar first; the last round takes all.
ASKED = (8, None)
#: Classes of a crowded run that are all compared with one another.
REGION = 512
#: Links from which a class is compared with all of a longer run, and how many such classes are compared at once.
SATURATED, HUBS = 24, 64
#: Sketch comparisons of a crowded run made at once, and those of them that go on to wide sketches.
CELLS, WIDE = 1 << 18, 1 << 14
#: Sketched similarity below which a candidate is dropped: more than four deviations under the threshold.
LEAST = 0.55
#: Bins of the wide sketch that is compared in crowded runs, and the deviations under the threshold below which a pair is dropped.
BINS, DEVIATIONS = 1024, 4.5
SEGMENT = 1 << 18
#: Bits of a table that drops rows where they are read: sixteen for each id, within these powers of two.
TABLE_BITS = (20, 28)

_HASHES = TREES * DEPTH
_RNG = np.random.default_rng(20)
_FACTORS = (_RNG.integers(0, 1 << 32, _HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_SHIFTS = _RNG.integers(0, 1 << 32, _HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(12, n.bit_length())
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(data, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of bytes other than white space, A-Z in lower case) of UTF-8 texts that lie in a row, and the
    number of words before each text."""
    raw = np.frombuffer(data, np.uint8)
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    inside = ~((raw == 32) | (raw >= 9) & (raw <= 13))
    head = np.zeros(len(raw) + 1, bool)
    head[offsets] = True
    begins = inside & (np.concatenate([[True], ~inside[:-1]]) | head[:-1])
    ends = inside & (np.concatenate([~inside[1:], [True]]) | head[1:])
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[low] * up[: len(raw)], out=prefix[1:])
    return _mixed((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64)), np.searchsorted(s, offsets)


def shingle_sets(data, offsets: np.ndarray) -> list[np.ndarray]:
    """Each text's set as sorted distinct hashes."""
    words, bounds = word_hashes(data, offsets)
    n = np.diff(bounds)
    if len(words) >= SHINGLE:
        m = len(words) - SHINGLE + 1
        h = np.full(m, 0x243F6A8885A308D3, np.uint64)
        for k in range(SHINGLE):
            h = (h ^ words[k : k + m]) * np.uint64(_BASE)
            h ^= h >> np.uint64(29)
        h = _mixed(h)
    sets = []
    for i, count in enumerate(n.tolist()):
        a = int(bounds[i])
        if count >= SHINGLE:
            sets.append(np.unique(h[a : a + count - SHINGLE + 1]))
        elif count:
            sets.append(np.frombuffer(xxhash.xxh3_64_digest(words[a : a + count].tobytes()), np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signature(found: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over the set."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    best = np.full(_HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(best, (x[None, i : i + 2048] * _FACTORS + _SHIFTS).min(1), out=best)
    return best


def sketch(mins: np.ndarray) -> np.ndarray:
    """Two bits of each minimum: rows of _HASHES minima to rows of bytes."""
    x = mins * np.uint32(0x9E3779B1)
    two = ((x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)) >> np.uint32(30)
    bits = np.stack([two >> np.uint32(1), two & np.uint32(1)], -1).astype(np.uint8)
    return np.packbits(bits.reshape(*mins.shape[:-1], -1), axis=-1)


def wide_sketch(found: np.ndarray) -> bytes:
    """The bins of the hashes' upper bits that a sorted set fills, and a bit of the smallest hash in each."""
    bins = (found >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    planes = np.zeros((2, BINS), np.uint8)
    planes[0, bins[first]] = 1
    planes[1, bins[first]] = found[first] & np.uint64(1)
    return np.packbits(planes).tobytes()


def _may_be_linked(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of pairs of wide sketches, as rows of words, and whether it is near the threshold. A bin of both sets
    has the same smallest hash with the chance of the similarity, and if not, the same bit with a chance of one half. The deviation
    is that at the threshold; where bins hold one hash each, nothing is left to chance but the bits."""
    half = x.shape[1] // 2
    either = np.bitwise_count(x[:, :half] | y[:, :half]).sum(1, dtype=np.int64)
    filled = x[:, :half] & y[:, :half]
    both = np.bitwise_count(filled).sum(1, dtype=np.int64)
    equal = np.bitwise_count(filled & ~(x[:, half:] ^ y[:, half:])).sum(1, dtype=np.int64)
    share = (2 * equal - both) / either
    least = THRESHOLD / 100
    union = np.maximum((sizes + others) / (1 + least), either)
    spread = np.maximum(both - least * either, 0) + least * (1 - least) * either * (1 - either / union) + 1
    return share, share >= least - DEVIATIONS * np.sqrt(spread) / either


@trimmed
def _scan(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, digest of the set, and signature with sketch of each text."""
    for batch in found:
        data, offsets = text_views(batch.column(1))
        for i, j in groups_of(offsets, SEGMENT):
            sets = shingle_sets(data[int(offsets[i]) : int(offsets[j])], offsets[i : j + 1] - offsets[i])
            mins = np.stack([signature(x) for x in sets])
            both = np.concatenate([mins.astype(">u4").view(np.uint8), sketch(mins)], 1)
            wide = pa.array([wide_sketch(x) if len(x) else None for x in sets], pa.binary())
            digests = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array([len(x) for x in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array([b.tobytes() if d else None for b, d in zip(both, digests, strict=True)], pa.binary()), wide],
                names=["doc_id", "n_shingles", "digest", "mins", "wide"],
            )


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    buffers = column.buffers()
    if not len(column):
        return np.zeros((0, width), np.uint8)
    first = np.frombuffer(buffers[1], np.int32)[column.offset]
    return np.frombuffer(buffers[2], np.uint8)[first : first + width * len(column)].reshape(-1, width)


def _alike(x: np.ndarray) -> np.ndarray:
    """Hashes whose two bits agree, of the xor of sketches as words in the last axis."""
    return _HASHES - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(-1, dtype=np.int64)


def _fits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can reach the threshold at all."""
    return 100 * np.minimum(x, y) >= THRESHOLD * np.maximum(x, y)


def _may(same: np.ndarray) -> np.ndarray:
    """Whether sketches with so many equal hashes may belong to sets that reach the threshold."""
    return (same / _HASHES - 0.25) / 0.75 >= LEAST


_TREES = pa.schema([("id", pa.int64()), ("tree_key", pa.binary()), ("sketch", pa.binary()), ("size", pa.int64())])
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("same", pa.int64()), ("part", pa.int64()), ("tree_key", pa.binary()), ("sketch", pa.binary()), ("size", pa.int64())])
FOUND = "a long, b long, same long, part long, tree_key binary, sketch binary, size long"


class _Sorted:
    """The last rows of a sorted tree and those that came now: ids, keys, sketches, sizes and partitions."""

    def __init__(self):
        self.columns = [np.zeros(0, np.int64), np.zeros((0, 1 + 4 * DEPTH), np.uint8), np.zeros((0, _HASHES // 4), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)]

    def add(self, batch: pa.RecordBatch, part: int | None) -> int:
        """How many rows there were."""
        old = len(self.columns[0])
        parts = batch.column(4).to_numpy() if part is None else np.full(len(batch), part)
        new = [batch.column(0).to_numpy(), _fixed(batch.column(1), 1 + 4 * DEPTH), _fixed(batch.column(2), _HASHES // 4), batch.column(3).to_numpy(), parts]
        self.columns = [np.concatenate([x, y]) for x, y in zip(self.columns, new, strict=True)]
        return old

    def near(self, old: int, across: bool) -> np.ndarray:
        """Pairs of rows at most WINDOW apart, the later one from ``old`` on, that agree in tree and first minimum and, by their
        sizes and sketches, may reach the threshold: rows of smaller id, larger id and equal hashes. ``across``: only pairs of
        different partitions."""
        ids, keys, sketches, sizes, parts = self.columns
        first, words = np.ascontiguousarray(keys[:, :5]), np.ascontiguousarray(sketches).view(np.uint64)
        found = [np.zeros((0, 3), np.int64)]
        for step in range(1, WINDOW + 1):
            x = np.arange(max(0, old - step), len(ids) - step)
            y = x + step
            good = (first[x] == first[y]).all(1) & (ids[x] != ids[y]) & _fits(sizes[x], sizes[y])
            if across:
                good &= parts[x] != parts[y]
            x, y = x[good], y[good]
            same = _alike(words[x] ^ words[y])
            keep = _may(same)
            found.append(np.stack([np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y]), same], 1)[keep])
        return np.unique(np.concatenate(found), axis=0)

    def crowded(self) -> np.ndarray:
        """Tree and first value of rows further apart than the window."""
        first = self.columns[1][:, :5]
        return np.unique(first[WINDOW + 1 :][(first[WINDOW + 1 :] == first[: -WINDOW - 1]).all(1)], axis=0)

    def rows(self, at: slice) -> pa.RecordBatch:
        ids, keys, sketches, sizes, parts = (c[at] for c in self.columns)
        blank = pa.nulls(len(ids), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(ids), blank, blank, pa.array(parts), pa.array([k.tobytes() for k in keys], pa.binary()), pa.array([k.tobytes() for k in sketches], pa.binary()), pa.array(sizes)], schema=_FOUND)

    def cut(self) -> None:
        self.columns = [c[-WINDOW - 1 :] for c in self.columns]


def _neighbours(across: bool = False):
    """Candidate pairs within a sorted partition and the crowded runs' tree and first value, then the rows at its edges."""

    @trimmed
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None if across else TaskContext.get().partitionId()
        rows, n, kept = _Sorted(), 0, 0
        for batch in found:
            old = rows.add(batch, part)
            n += len(batch)
            pairs = rows.near(old, across)
            none = pa.nulls(len(pairs), pa.binary())
            blank = pa.nulls(len(pairs), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(pairs[:, k])) for k in range(3)), blank, none, none, blank], schema=_FOUND)
            runs = rows.crowded()
            blank = pa.nulls(len(runs), pa.int64())
            yield pa.RecordBatch.from_arrays([blank, blank, blank, blank, pa.array([r.tobytes() for r in runs], pa.binary()), pa.nulls(len(runs), pa.binary()), blank], schema=_FOUND)
            if not across and kept <= WINDOW:
                begun = len(rows.columns[0]) - (n - kept)
                yield rows.rows(slice(begun, begun + WINDOW + 1 - kept))
                kept = min(n, WINDOW + 1)
            rows.cut()
        if not across and n > kept:
            yield rows.rows(slice(len(rows.columns[0]) - min(WINDOW + 1, n - kept), None))

    return run


def _proposed(a: np.ndarray, b: np.ndarray, cut: np.ndarray) -> pa.RecordBatch:
    """Distinct pairs, the smaller id first, and a row with a null ``b`` for each id that has more."""
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    more = pa.array(cut, pa.int64())
    return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), more]), pa.concat_arrays([pa.array(np.ascontiguousarray(pairs[:, 1])), pa.nulls(len(more), pa.int64())])], names=["a", "b"])


@dataclass
class _Region:
    """Rows of a region, or some of them: run, id, component, sketch, wide sketch, size, the first value in each tree, the block in
    each tree whose run is cut into blocks (else -1), and whether the row is of the next block."""

    runs: np.ndarray
    ids: np.ndarray
    groups: np.ndarray
    sketches: np.ndarray
    wide: np.ndarray
    sizes: np.ndarray
    firsts: np.ndarray
    blocks: np.ndarray
    following: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, s: int, e: int) -> _Region:
        part = batch.slice(s, e - s)
        fixed = lambda k, width: _fixed(part.column(k), width).copy()
        plain = lambda k: part.column(k).to_numpy(zero_copy_only=False).copy()
        return cls(fixed(1, 5), plain(2), plain(3), fixed(4, _HASHES // 4), fixed(5, BINS // 4), plain(6), fixed(7, 4 * TREES).view(np.uint32), part.column(8).flatten().to_numpy().reshape(-1, TREES).copy(), plain(9))

    @classmethod
    def joined(cls, parts: list[_Region]) -> _Region:
        return cls(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(cls)))

    def met_before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether pairs are also compared in an earlier tree: they share its first value, and its run is whole or has them in the
        same or adjacent blocks."""
        apart = np.abs(self.blocks[x] - self.blocks[y])
        earlier = np.arange(TREES) < self.runs[x][:, :1]
        return ((self.firsts[x] == self.firsts[y]) & (apart <= 1) & earlier).any(1)

    def apart(self, most: int | None) -> Iterator[pa.RecordBatch]:
        """Pairs that share their run, whose components differ and that may reach the threshold, each in the first tree that has it:
        of each class outside the largest component the ``most`` most similar ones, or all."""
        _, own, counts = np.unique(self.groups, return_inverse=True, return_counts=True)
        _, run = np.unique(self.runs, axis=0, return_inverse=True)
        ids, sizes, late = self.ids, self.sizes, self.following
        largest = own == counts.argmax()
        words, more = np.ascontiguousarray(self.sketches).view(np.uint64), np.ascontiguousarray(self.wide).view(np.uint64)
        step = max(1, CELLS // len(ids))
        asks = np.flatnonzero(~largest)
        for i in range(0, len(asks), step):
            q = asks[i : i + step]
            may = (own[q][:, None] != own[None]) & (run[q][:, None] == run[None]) & _fits(sizes[q][:, None], sizes[None]) & ~(late[q][:, None] & late[None])
            may &= _may(_alike(words[q][:, None] ^ words[None]))
            row, column = np.nonzero(may)
            # a pair of two that ask comes from the first of them
            once = largest[column] | (q[row] < column) if most is None else np.ones(len(row), bool)
            row, column = row[once], column[once]
            found = [_may_be_linked(more[q[r]], more[c], sizes[q[r]], sizes[c]) for r, c in ((row[k : k + WIDE], column[k : k + WIDE]) for k in range(0, len(row), WIDE))]
            share, good = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, kind) for k, kind in ((0, float), (1, bool)))
            good[good] = ~self.met_before(q[row[good]], column[good])
            row, column, share = row[good], column[good], share[good]
            cut = np.zeros(0, np.int64)
            if most and len(row):
                order = np.lexsort((ids[column], -share, row))
                row, column = row[order], column[order]
                n = np.bincount(row, minlength=len(q))
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                row, column, cut = row[place < most], column[place < most], ids[q[n > most]]
            yield _proposed(ids[q[row]], ids[column], cut)


def _crowd(most: int | None):
    """The pairs of ``_Region.apart`` of each region of rows sorted by it."""

    @trimmed
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Region] = []
        key = None
        for batch in found:
            regions = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], regions[1:] != regions[:-1]])[: len(regions)])
            for s, e in zip(starts, np.append(starts[1:], len(regions)), strict=True):
                if regions[s] != key:
                    if held:
                        yield from _Region.joined(held).apart(most)
                    key, held = regions[s], []
                held.append(_Region.of(batch, s, e))
        if held:
            yield from _Region.joined(held).apart(most)

    return run


@trimmed
def _against_hubs(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each ``id, component, sketch, size`` with those of the ``hubs`` beside it."""
    for batch in found:
        for i in range(0, len(batch), 1024):
            part = batch.slice(i, 1024)
            hubs = part.column(4)
            row = np.repeat(np.arange(len(part)), np.diff(hubs.offsets.to_numpy()))
            ids, groups, sizes = (part.column(k).to_numpy()[row] for k in (0, 1, 3))
            words = np.ascontiguousarray(_fixed(part.column(2), _HASHES // 4)).view(np.uint64)[row]
            flat = hubs.flatten()
            other, their, size = (flat.field(k).to_numpy() for k in (0, 1, 3))
            theirs = np.ascontiguousarray(_fixed(flat.field(2), _HASHES // 4)).view(np.uint64)
            good = (groups != their) & _fits(sizes, size) & _may(_alike(words ^ theirs))
            yield _proposed(ids[good], other[good], np.zeros(0, np.int64))


class _Sets:
    """The sets of the texts seen last."""

    def __init__(self, most: int = 256):
        self.most, self.kept = most, OrderedDict()

    def get(self, key: int, text: str) -> np.ndarray:
        own = (key, hash(text))  # texts may share an id
        found = self.kept.get(own)
        if found is None:
            data = text.encode()
            found = self.kept[own] = shingle_sets(data, np.array([0, len(data)]))[0]
            if len(self.kept) > self.most:
                self.kept.popitem(last=False)
        else:
            self.kept.move_to_end(own)
        return found


@trimmed
def _confirm(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = _Sets()
    for batch in found:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        linked = []
        for k in range(len(a)):
            x, y = sets.get(a[k], batch.column(2)[k].as_py()), sets.get(b[k], batch.column(3)[k].as_py())
            common = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * common >= THRESHOLD * (len(x) + len(y) - common))
        keep = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def candidate_pairs(trees: DataFrame) -> tuple[DataFrame, str, DataFrame, str]:
    """``a, b, same`` of distinct neighbours in the sorted orders of ``id, tree_key, sketch, size`` rows, and ``run, tree_key, id,
    sketch, size`` of the crowded runs, each written, and where."""
    own = ["id", "tree_key", "sketch", "size"]
    dealt = trees.repartitionByRange("tree_key", "id").sortWithinPartitions("tree_key", "id")
    near, near_path = written(dealt.select(own).mapInArrow(_neighbours(), FOUND), "neighbours")
    # a few rows for each partition, whatever the size of the data
    edges = near.filter("a is not null and b is null").withColumnRenamed("a", "id").select(*own, "part").repartition(1).sortWithinPartitions("tree_key", "id", "part")
    both = near.union(edges.mapInArrow(_neighbours(across=True), FOUND))
    pairs, pair_path = written(both.filter("b is not null").select("a", "b", "same").distinct(), "pairs")
    runs = both.filter("a is null").select(F.col("tree_key").alias("run")).distinct()
    placed = trees.select(F.expr("substring(tree_key, 1, 5)").alias("run"), "tree_key", "id", "sketch", "size")
    crowded, crowded_path = written(placed.join(runs, "run", "left_semi"), "crowded")
    remove(trees.sparkSession, near_path)
    return pairs, pair_path, crowded, crowded_path


def leading(pairs: DataFrame, n: int) -> DataFrame:
    """The ``n`` pairs of each end whose sketches agree most; among those that agree about as much, any."""
    ends = pairs.select(F.col("a").alias("end"), "a", "b", "same").union(pairs.select("b", "a", "b", "same"))
    order = W.partitionBy("end").orderBy(F.expr("same div 8").desc(), F.xxhash64("a", "b"), "a", "b")  # an end has 2 * TREES * WINDOW pairs at most
    return ends.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= n).select("a", "b").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame) -> tuple[DataFrame, str]:
    """Those of the pairs ``a, b`` whose full sets reach the threshold, written. ``texts``: ``doc_id, text``."""
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return written(both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long").distinct(), "links")


def _of_both(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()


def _apart_only(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components so far."""
    own = lambda end, name: found.select(F.col("id").alias(end), F.col("component").alias(name))
    placed = pairs.join(own("a", "_ca"), "a", "left").join(own("b", "_cb"), "b", "left")
    return placed.filter(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select(pairs.columns)


def linked(docs: DataFrame, pairs: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """``id, component`` by the pairs that are confirmed and by ``more`` edges; the links; and the tables written."""
    spark = docs.sparkSession
    texts, text_path = written(texts_of(docs, _of_both(pairs)), "texts")
    first, first_path = written(leading(pairs, FIRST), "first")
    links, path = confirmed(first, texts)
    found = connected_components(links.union(more), "a", "b")
    rest, rest_path = written(_apart_only(pairs.select("a", "b").join(first, ["a", "b"], "left_anti"), found), "rest")
    paths = [path]
    if not rest.isEmpty():
        others, path = confirmed(rest, texts)
        paths.append(path)
        if not others.isEmpty():
            links = links.union(others)
            found = connected_components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(others), "a", "b")
    remove(spark, text_path, first_path, rest_path)
    return found, links, paths


def regions(crowded: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``region, run, id, sketch, size, following, blocks`` of the crowded runs with the columns of ``classes``: a run of at most REGION
    rows is a region; longer ones are cut in their sorted order, each REGION rows together with the next ones. And the rows of the
    longer runs, or none."""
    rest = ["run", "id", "sketch", "size"]
    classes = classes.join(crowded.select("id").distinct(), "id", "left_semi")
    whole = lambda df: df.select(F.xxhash64("run").alias("region"), *rest, F.lit(False).alias("following"))
    none = F.array_repeat(F.lit(-1).cast("long"), TREES)
    long, _ = written(crowded.groupBy("run").count().filter(F.col("count") > REGION).select("run"), "long")
    if long.isEmpty():
        return whole(crowded).join(classes.withColumn("blocks", none), "id"), None
    big, _ = written(crowded.join(long, "run", "left_semi"), "big")
    cut = global_positions(big, ["tree_key", "id"], "place").withColumn("block", F.floor(F.col("place") / REGION))
    tree = F.ascii(F.expr("decode(substring(run, 1, 1), 'ISO-8859-1')"))
    blocks = cut.groupBy("id").agg(F.array(*[F.coalesce(F.max(F.when(tree == t, F.col("block"))), F.lit(-1)) for t in range(TREES)]).alias("blocks"))
    both = F.explode(F.array(F.struct(F.col("block").alias("region"), F.lit(False).alias("following")), F.struct((F.col("block") - 1).alias("region"), F.lit(True).alias("following"))))
    dealt = cut.select(both.alias("r"), *rest).select("r.region", *rest, "r.following")
    out = whole(crowded.join(long, "run", "left_anti")).union(dealt)
    return out.join(classes.join(blocks, "id", "left").withColumn("blocks", F.coalesce("blocks", none)), "id"), big


def hubs_of(big: DataFrame, links: DataFrame) -> DataFrame:
    """``run, id, sketch, size`` of the classes in longer runs that have SATURATED links or more."""
    ends = links.select("a").union(links.select("b")).withColumnRenamed("a", "id")
    hubs = ends.groupBy("id").count().filter(F.col("count") >= SATURATED).select("id")
    return big.select("run", "id", "sketch", "size").join(hubs, "id", "left_semi")


def _beside_hubs(big: DataFrame, hubs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of the longer runs' rows with their runs' hubs, which come in groups of about HUBS."""
    placed = lambda df: df.join(found, "id", "left").select("run", "id", F.coalesce("component", "id").alias("component"), "sketch", "size")
    n = F.count("*").over(W.partitionBy("run"))
    salted = placed(hubs).withColumn("salt", F.pmod(F.xxhash64("id"), F.ceil(n / HUBS)))
    groups, _ = written(salted.groupBy("run", "salt").agg(F.collect_list(F.struct("id", "component", "sketch", "size")).alias("hubs")), "hubs")
    own, _ = written(placed(big), "placed")
    return own.join(groups, "run").select("id", "component", "sketch", "size", "hubs").mapInArrow(_against_hubs, "a long, b long")


def joined_crowds(docs: DataFrame, crowded: DataFrame, classes: DataFrame, pairs: DataFrame, found: DataFrame, links: DataFrame) -> DataFrame:
    """``id, component`` after the links within the crowded runs. ``pairs``: those that have been judged already."""
    spark = docs.sparkSession
    dealt, big = regions(crowded, classes)
    dealt, _ = written(dealt, "regions")
    judged = pairs.select("a", "b")
    for most in ASKED:
        known = dealt.join(found, "id", "left").select("region", "run", "id", F.coalesce("component", "id").alias("component"), "sketch", "wide", "size", "firsts", "blocks", "following")
        asked = known.repartition("region").sortWithinPartitions("region", "run", "id").mapInArrow(_crowd(most), "a long, b long")
        if big is not None and most is not None:
            asked = asked.union(_beside_hubs(big, hubs_of(big, links), found))
        proposed, _ = written(asked.distinct(), "proposed")
        new, _ = written(proposed.filter("b is not null").join(judged, ["a", "b"], "left_anti"), "new")
        if not new.isEmpty():
            texts, path = written(texts_of(docs, _of_both(new)), "texts")
            more, _ = confirmed(new, texts)
            remove(spark, path)
            if not more.isEmpty():
                found = connected_components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more), "a", "b")
        if proposed.filter("b is null").isEmpty():
            break
        judged = judged.union(new)
    return found


def _where(table: np.ndarray, marked: bool):
    """Rows whose last column, a place in the bit table, is marked, or those where it is not; without that column."""

    @trimmed
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            last = batch.num_columns - 1
            place = batch.column(last).fill_null(-1).to_numpy()
            bit = ((table[place >> 3] >> (place & 7)) & 1).astype(bool) & (place >= 0)
            yield batch.filter(pa.array(bit == marked)).select(list(range(last)))

    return run


def _place(doc_id: Column, bits: int) -> Column:
    return F.when(doc_id.isNotNull(), F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(1 << bits)))


def bit_table(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A table with a bit for the hash of each ``doc_id``, sixteen times as many as ids within TABLE_BITS, and the power of two."""
    low, high = TABLE_BITS
    bits = min(high, max(low, (16 * ids.count()).bit_length()))
    own = ids.select((_place(F.col("doc_id"), bits) + 1).alias("v"))
    pages = own.groupBy(F.bitmap_bucket_number("v").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))
    table = np.zeros(1 << (bits - 3), np.uint8)
    for batch in pages.toArrow().to_batches():  # at most 2 ** bits bits in all, by one job, not one for each partition
        for page, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            page_bits = np.frombuffer(own.as_buffer(), np.uint8)
            at = (page - 1) * len(page_bits)
            table[at : at + len(page_bits)] = page_bits
    return table, bits


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``doc_id, text`` whose id is wanted. A bit table drops most others where they are read, so that not all texts are
    shuffled; the join decides."""
    table, bits = bit_table(wanted)
    placed = docs.filter("doc_id is not null and text is not null").select("doc_id", "text", _place(F.col("doc_id"), bits).alias("place"))
    some = placed.mapInArrow(_where(table, True), "doc_id long, text string")
    return some.join(wanted, "doc_id", "left_semi").dropDuplicates()


def shared_ids(full: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b``: classes that hold texts of one id, each with the smallest of them."""
    several = full.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    own = full.select("doc_id", "digest").join(several, "doc_id", "left_semi").distinct().join(classes, "digest")
    return own.join(own.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").select("a", F.col("id").alias("b"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    spark = documents.sparkSession
    with only(spark) as keep:
        docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        scanned, _ = written(docs.mapInArrow(_scan, "doc_id long, n_shingles long, digest binary, mins binary, wide binary"), "scanned")
        full = scanned.filter("digest is not null and doc_id is not null")
        classes, _ = written(full.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
        chosen = full.select("digest", F.col("doc_id").alias("id"), "n_shingles", "mins", "wide").join(classes, ["digest", "id"], "left_semi").dropDuplicates(["digest", "id"])
        tree = F.explode(F.expr(f"sequence(0, {TREES - 1})"))
        width = 4 * DEPTH
        trees = chosen.select("id", "n_shingles", "mins", tree.alias("tree")).select(
            "id",
            F.concat(F.expr("substring(encode(char(tree), 'ISO-8859-1'), 1, 1)"), F.expr(f"substring(mins, 1 + {width} * tree, {width})")).alias("tree_key"),
            F.expr(f"substring(mins, {1 + TREES * width}, {_HASHES // 4})").alias("sketch"),
            F.col("n_shingles").alias("size"),
        )
        firsts = chosen.select("id", "wide", F.concat(*[F.expr(f"substring(mins, {1 + width * t}, 4)") for t in range(TREES)]).alias("firsts"))
        trees, tree_path = written(trees, "trees")
        pairs, _, crowded, _ = candidate_pairs(trees)
        remove(spark, tree_path)
        found, links, _ = linked(docs, pairs, shared_ids(full, classes))
        found = joined_crowds(docs, crowded, firsts, pairs, found, links)
        named = classes.join(found, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
        out = scanned.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        out = out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        return keep(*written(out, "judged"))


#: All pairs that share a shingle, and what can be reached by those of them that are linked.
OP3_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS own FROM d),
x AS (SELECT doc_id, len(own) AS n, unnest(own) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c WHERE 100 * k >= 75 * (n + m - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
g AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(own) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN g USING (doc_id)
"""


def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def deduplicate(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each near-duplicate component, columns unchanged; rows that repeat both id and text are one."""
    judged = near_duplicates(documents)
    dropped, _ = written(judged.filter("not kept").select("doc_id").distinct(), "dropped")
    # only rows whose bit is set can be dropped: the others are not shuffled
    (table, bits), name = bit_table(dropped), "_" * (1 + max(map(len, documents.columns)))
    placed = documents.withColumn(name, _place(F.col("doc_id"), bits))
    schema = T.StructType(documents.schema.fields)
    marked = placed.mapInArrow(_where(table, True), schema).join(dropped, "doc_id", "left_anti").select(documents.columns)
    kept = placed.mapInArrow(_where(table, False), schema).union(marked)
    repeated = judged.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").select(documents.columns).dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").select(documents.columns).union(once)
