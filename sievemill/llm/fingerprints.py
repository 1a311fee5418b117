"""Document fingerprints by MinHash, what an edit does to them, and the documents that bands of them bring together.

A text's shingles are its runs of five words, A-Z in lower case, the first words preceded by blanks, so that a text has as many
runs as words. HASHES multiply-add-shift permutations, drawn once from a fixed seed, are applied to all shingles of a block of
texts in numpy; a fingerprint keeps sixteen bits of each minimum, and likeness is the share of places that agree.

``edited`` pairs each document with the next one: rows are dealt into sorted ranges of ids, each range is one pass that holds two
rows at a time, and the last row of a range meets the first of the next one by a join of one row for each range. Texts are shuffled
once, packed with zstandard.

``near_documents`` cuts fingerprints into bands. Texts of equal shingle sets are one class before anything else. Each class is
joined with the smallest class of each of its band values, the pairs are verified by Jaccard similarity on full sets of five-word
shingles, and components follow. Whoever is not in the component of its band's smallest class is then joined with all the band's
classes that lie in other components: a band's classes come in blocks, two of which are a row, and set sizes and a sketch of 1,024
bins, compared in numpy, keep what may reach the threshold. No pair within a component is formed, and none that shares a band and lies across components is left out but by the
sketch, 4.5 deviations under the threshold.

Defined results: null and empty texts, and texts of white space, have the fingerprint of the empty set, whose likeness to one
another is 1, and belong to no class; documents are in the order of ids, rows that repeat an id in the order of a hash of their
texts, null ids last; the next of the last is the first, a document alone is its own next; equal texts have equal fingerprints;
every row comes back, repeated ones too; texts that share an id are one document to ``near_documents``; a null ``doc_id`` has a null
``near_id``; a very long text is hashed in segments that end at white space; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.operators.components import connected_components

from .near_dup import BINS, DEVIATIONS, SHINGLE, THRESHOLD, _fits, _fixed, _may_be_linked, confirmed, shared_ids, shingle_sets, texts_of, wide_sketch, word_hashes
from .shared import groups_of, only, ragged, text_views, trimmed, written

HASHES = 64
BANDS = 16
SEGMENT = 1 << 20
#: Classes of a band in a block, and pairs that are compared at once.
BLOCK = 512
AT_ONCE = 1 << 14
#: Words of a wide sketch: the bins that a set fills, and a bit of each.
WORDS = 2 * BINS // 64

_RNG = np.random.default_rng(11)
_FACTORS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2)
_BLANK = np.uint64(0x452821E638D01377)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _shingles(words: np.ndarray) -> np.ndarray:
    """A hash of each run of five word hashes."""
    m = max(0, len(words) - SHINGLE + 1)
    h = np.full(m, 0x13198A2E03707344, np.uint64)
    for k in range(SHINGLE):
        h = (h ^ words[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def _minima(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The minimum of each permutation over each text's shingles; texts without any have the greatest value."""
    some = np.flatnonzero(np.diff(bounds))
    out = np.full((len(bounds) - 1, HASHES), 0xFFFFFFFF, np.uint32)
    for k in range(HASHES if len(some) else 0):
        value = ((shingles * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32)).astype(np.uint32)
        out[some, k] = np.minimum.reduceat(value, bounds[some])
    return out


def _pieces(raw: bytes, size: int) -> Iterator[bytes]:
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + size)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def _of_long(raw: bytes, segment: int) -> tuple[np.ndarray, bytes]:
    """Minima and digest of the set of a long text, a segment at a time; the last words of one precede the next."""
    best, seen, before = np.full(HASHES, 0xFFFFFFFF, np.uint32), np.zeros(0, np.uint64), np.full(SHINGLE - 1, _BLANK)
    for piece in _pieces(raw, segment):
        words = np.concatenate([before, word_hashes(piece, np.array([0, len(piece)]))[0]])
        own = np.unique(_shingles(words))
        if len(own):
            np.minimum(best, _minima(own, np.array([0, len(own)]))[0], out=best)
            seen, before = np.union1d(seen, own), words[-SHINGLE + 1 :]
    return best, xxhash.xxh3_128_digest(seen.tobytes()) if len(seen) else b""


def fingerprints(texts: list[bytes], segment: int = SEGMENT) -> tuple[np.ndarray, list[bytes]]:
    """Sixteen bits of each minimum, and a digest of the set of shingles, empty without any, of texts in UTF-8."""
    minima, keys = np.zeros((len(texts), HASHES), np.uint32), [b""] * len(texts)
    offsets = np.cumsum([0, *map(len, texts)])
    for i, j in groups_of(offsets, segment):
        if offsets[j] - offsets[i] > segment:
            minima[i], keys[i] = _of_long(texts[i], segment)
            continue
        words, bounds = word_hashes(b"".join(texts[i:j]), offsets[i : j + 1] - offsets[i])
        counts = np.diff(bounds)
        # each text's words with blanks before them
        starts = bounds[:-1] + (SHINGLE - 1) * np.arange(len(counts))
        padded = np.full(len(words) + (SHINGLE - 1) * len(counts), _BLANK)
        padded[ragged(starts + SHINGLE - 1, counts)] = words
        shingles = _shingles(padded)[ragged(starts, counts)]
        minima[i:j] = _minima(shingles, bounds)
        for k, (a, b) in enumerate(itertools.pairwise(bounds.tolist())):
            if b > a:
                keys[i + k] = xxhash.xxh3_128_digest(np.unique(shingles[a:b]).tobytes())
    return minima.astype(np.uint16), keys


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).mean(-1)


def bands(prints: np.ndarray) -> np.ndarray:
    """BANDS values of each fingerprint, of four places each."""
    return np.ascontiguousarray(prints).view(np.int64)


def as_text(prints: np.ndarray) -> list[str]:
    return [base64.b64encode(p.tobytes()).decode() for p in prints]


def edit(text: str, following: str) -> str:
    """The text, its last half replaced by as many characters, or all, from the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


@dataclass
class _Rows:
    """Some rows in order: ids, texts, fingerprints and digests."""

    ids: list
    texts: list[str]
    prints: np.ndarray
    keys: list[bytes]

    @classmethod
    def of(cls, ids: list, packed: list[bytes]) -> _Rows:
        raw = [zstandard.decompress(p) for p in packed]
        return cls(ids, [r.decode(errors="surrogateescape") for r in raw], *fingerprints(raw))

    def followed_by(self, other: _Rows) -> _Rows:
        return _Rows(self.ids + other.ids, self.texts + other.texts, np.concatenate([self.prints, other.prints]), self.keys + other.keys)

    def at(self, s: slice) -> _Rows:
        return _Rows(self.ids[s], self.texts[s], self.prints[s], self.keys[s])

    def beside(self, following: _Rows) -> pa.RecordBatch:
        """The finished rows, each with the one that follows it."""
        changed = [edit(a, b).encode(errors="surrogateescape") for a, b in zip(self.texts, following.texts, strict=True)]
        prints, _ = fingerprints(changed)
        finished = [pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()), pa.array(as_text(prints), pa.string()), pa.array(likeness(self.prints, prints)), pa.array(likeness(self.prints, following.prints))]
        none = [pa.nulls(len(self.ids), pa.int32()), pa.nulls(len(self.ids), pa.string()), pa.nulls(len(self.ids), pa.binary())]
        return pa.RecordBatch.from_arrays(self._own() + finished + none, schema=_ARROW)

    def edge(self, part: int, place: str) -> pa.RecordBatch:
        """The only row, with its text, for the join across ranges."""
        none = [pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.float64())]
        packed = zstandard.compress(self.texts[0].encode(errors="surrogateescape"), 1)
        return pa.RecordBatch.from_arrays(self._own() + none + [pa.array([part], pa.int32()), pa.array([place]), pa.array([packed], pa.binary())], schema=_ARROW)

    def _own(self) -> list[pa.Array]:
        values = bands(self.prints)
        some = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.reshape(-1)))
        return [pa.array(self.ids, pa.int64()), pa.array([len(t) for t in self.texts], pa.int64()), pa.array([k or None for k in self.keys], pa.binary()), some, pa.array(as_text(self.prints), pa.string())]


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("fingerprint", pa.string()), ("edited_sha256", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()), ("place", pa.string()), ("packed", pa.binary())]
)
_FINISHED = "doc_id long, n_chars long, digest binary, bands array<long>, fingerprint string, edited_sha256 string, edited_fingerprint string, near_edited double, near_next double, part int, place string, packed binary"
_RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@trimmed
def _pack(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text packed."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in found:
        data, offsets = text_views(batch.column(3))
        packed = pa.array([packer.compress(data[a:b]) for a, b in itertools.pairwise(offsets.tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed, pa.array(np.diff(offsets))], names=["doc_id", "tie", "row", "packed", "size"])


@trimmed
def _in_order(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range, each with the next one; its first and last once more, for the ranges beside it."""
    part, last = TaskContext.get().partitionId(), None
    for batch in found:
        sizes = np.concatenate([[0], np.cumsum(batch.column(4).to_numpy())])
        for i, j in groups_of(sizes, SEGMENT):
            rows = _Rows.of(batch.column(0).slice(i, j - i).to_pylist(), batch.column(3).slice(i, j - i).to_pylist())
            if last is None:
                yield rows.at(slice(0, 1)).edge(part, "first")
            else:
                rows = last.followed_by(rows)
            yield rows.at(slice(0, -1)).beside(rows.at(slice(1, None)))
            last = rows.at(slice(-1, None))
    if last is not None:
        yield last.edge(part, "last")


def _across(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last row of each range with the first of the next."""
    for batch in found:
        for k in range(len(batch)):
            own, other = (_Rows.of(batch.column(c).slice(k, 1).to_pylist(), batch.column(c + 1).slice(k, 1).to_pylist()) for c in (0, 2))
            yield own.beside(other)


def edited(documents: DataFrame) -> DataFrame:
    """Every row's fingerprint, digest and bands, and those of its edited text beside the next document's, written."""
    spark = documents.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    packed = rows.mapInArrow(_pack, "doc_id long, tie long, row long, packed binary, size long")
    order = [F.asc_nulls_last("doc_id"), "tie", "row"]  # equal rows are spread, too
    with only(spark) as keep:
        ranges, path = written(packed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_in_order, _FINISHED), "ranges")
        edges = ranges.filter("place is not null")
        parts = sorted(r.part for r in edges.filter("place = 'first'").select("part").collect())  # a row for each range
        following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, next int")
        last = edges.filter("place = 'last'").select("part", F.col("doc_id").alias("id_a"), F.col("packed").alias("a")).join(F.broadcast(following), "part")
        first = edges.filter("place = 'first'").select(F.col("part").alias("next"), F.col("doc_id").alias("id_b"), F.col("packed").alias("b"))
        met, met_path = written(last.join(first, "next").select("id_a", "a", "id_b", "b").mapInArrow(_across, _FINISHED), "met")
        return keep(ranges, path).filter("place is null").union(keep(met, met_path)).drop("part", "place", "packed")


def _banded(classes: DataFrame) -> DataFrame:
    """``id, band``: a row for each class and band; the band is a hash of its number and value."""
    return classes.select("id", F.explode(F.transform("bands", lambda v, i: F.xxhash64(i, v))).alias("band"))


@trimmed
def _sketches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size and wide sketch of each text."""
    for batch in found:
        data, offsets = text_views(batch.column(1))
        for i, j in groups_of(offsets, SEGMENT):
            sets = shingle_sets(data[int(offsets[i]) : int(offsets[j])], offsets[i : j + 1] - offsets[i])
            wide = pa.array([wide_sketch(x) for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([len(x) for x in sets], pa.int64()), wide], names=["id", "size", "wide"])


def may_be_linked(x: str, y: str) -> Column:
    """Whether the sets of two sides of a join, each with ``size`` and ``wide``, may reach the threshold: by their sizes, and by the
    bins that both fill and the bits that agree there. As near_dup has it for arrays, in the join's own expressions."""
    half = WORDS // 2
    total = lambda term: "(" + " + ".join(f"bit_count({term.format(x=x, y=y, a=k, b=k + half)})" for k in range(half)) + ")"
    either, both = total("{x}.wide[{a}] | {y}.wide[{a}]"), total("{x}.wide[{a}] & {y}.wide[{a}]")
    equal = total("{x}.wide[{a}] & {y}.wide[{a}] & ~({x}.wide[{b}] ^ {y}.wide[{b}])")
    least = THRESHOLD / 100
    union = f"greatest(({x}.size + {y}.size) / {1 + least}, {either})"
    spread = f"(greatest({both} - {least} * {either}, 0) + {least * (1 - least)} * {either} * (1 - {either} / {union}) + 1)"
    sizes = f"100 * least({x}.size, {y}.size) >= {THRESHOLD} * greatest({x}.size, {y}.size)"
    return F.expr(f"{sizes} AND 2 * {equal} - {both} >= {least} * {either} - {DEVIATIONS} * sqrt({spread})")


def _in_blocks(own: DataFrame, sketches: DataFrame) -> DataFrame:
    """``band, out, block, rows``: the classes of bands that hold some outside the component of their smallest class, those outside
    (``out``) and the others apart, in blocks of about BLOCK, with sizes and sketches. ``own``: ``band, id, component, of_leader``."""
    mixed = own.groupBy("band").agg(F.count("*").alias("n"), F.bool_or(F.col("component") != F.col("of_leader")).alias("any")).filter("any").select("band", "n")
    block = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)).alias("block")
    dealt = own.join(mixed, "band").select("band", (F.col("component") != F.col("of_leader")).alias("out"), block, "id", "component")
    return dealt.join(sketches, "id").groupBy("band", "out", "block").agg(F.collect_list(F.struct("id", "component", "size", "wide")).alias("rows"))


@trimmed
def _near_in_blocks(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of two blocks' rows, or of one block's with itself, that lie in different components and may reach the threshold."""
    for batch in found:
        itself = batch.column(2).to_pylist()
        for k, same in enumerate(itself):
            (a, ca, na, wa), (b, cb, nb, wb) = (_columns(batch.column(c)[k].values) for c in (0, 1))
            step = max(1, AT_ONCE // len(b))
            for i in range(0, len(a), step):
                own = slice(i, i + step)
                meet = (ca[own, None] != cb) & _fits(na[own, None], nb)
                if same:
                    meet &= a[own, None] < b
                x, y = np.nonzero(meet)
                x += i
                good = _may_be_linked(wa[x], wb[y], na[x], nb[y])[1]
                x, y = a[x[good]], b[y[good]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def _columns(rows: pa.StructArray) -> tuple[np.ndarray, ...]:
    """Ids, components, sizes and the words of sketches."""
    return *(rows.field(k).to_numpy() for k in range(3)), np.ascontiguousarray(_fixed(rows.field(3), 8 * WORDS)).view(np.uint64)


def _near_pairs(blocks: DataFrame) -> DataFrame:
    """``a, b``: pairs of a band's classes in different components, one at least outside that of the smallest, that may be linked."""
    x, y = blocks.filter("out").alias("x"), blocks.alias("y")
    once = ~F.col("y.out") | (F.col("x.block") <= F.col("y.block"))
    both = x.join(y, (F.col("x.band") == F.col("y.band")) & once)
    itself = F.col("y.out") & (F.col("x.block") == F.col("y.block"))
    return both.select(F.col("x.rows").alias("x"), F.col("y.rows").alias("y"), itself.alias("itself")).mapInArrow(_near_in_blocks, "a long, b long").distinct()


def _component(df: DataFrame, found: DataFrame) -> DataFrame:
    return df.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def near_documents(documents: DataFrame, prints: DataFrame) -> DataFrame:
    """``digest, near_id``: for each class of equal sets the smallest id that verified links reach; written. ``prints``: rows with
    ``doc_id, digest, bands``."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with only(spark) as keep:
        full = prints.filter("digest is not null and doc_id is not null").select("doc_id", "digest", "bands")
        values = [F.min(F.col("bands")[k]).alias(f"v{k}") for k in range(BANDS)]  # equal for equal sets
        classes = full.groupBy("digest").agg(F.min("doc_id").alias("id"), *values)
        classes, _ = written(classes.select("digest", "id", F.array(*[f"v{k}" for k in range(BANDS)]).alias("bands")), "classes")
        banded, _ = written(_banded(classes), "bands")
        shared = banded.groupBy("band").agg(F.min("id").alias("leader"), F.count("*").alias("n")).filter("n > 1").select("band", "leader")
        placed, _ = written(banded.join(shared, "band"), "placed")

        def links(pairs: DataFrame) -> DataFrame:
            wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
            texts, _ = written(texts_of(docs, wanted), "texts")
            return confirmed(pairs, texts)[0]

        stars, _ = written(placed.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
        found = links(stars)
        if not full.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            found = found.union(shared_ids(full, classes.select("digest", "id")))
        found = connected_components(found, "a", "b")
        own = _component(placed, found).select("band", "id", "component", "leader")
        leaders = found.select(F.col("id").alias("leader"), F.col("component").alias("of_leader"))
        own, _ = written(own.join(leaders, "leader", "left").withColumn("of_leader", F.coalesce("of_leader", "leader")).drop("leader"), "placed")
        outside = own.join(own.filter("component <> of_leader").select("band").distinct(), "band", "left_semi")
        sketches, _ = written(texts_of(docs, outside.select(F.col("id").alias("doc_id")).distinct()).mapInArrow(_sketches, "id long, size long, wide binary"), "sketches")
        blocks, _ = written(_in_blocks(own, sketches), "blocks")  # texts that share an id each have a row
        rest, _ = written(_near_pairs(blocks).join(stars, ["a", "b"], "left_anti"), "rest")
        if not rest.isEmpty():
            known = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
            found = connected_components(known.union(links(rest)), "a", "b")
        return keep(*written(_component(classes.select("digest", "id"), found).select("digest", F.col("component").alias("near_id")), "near"))


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Every row's fingerprint, edited text and likenesses, and ``near_id``, the smallest id of its near-duplicates."""
    spark = documents.sparkSession
    with only(spark) as keep:
        prints = edited(documents)
        near = near_documents(documents, prints)
        near_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("near_id", "doc_id"))
        out = prints.select(*_RESULT, "digest").join(near, "digest", "left").select(*_RESULT, near_id.alias("near_id"))
        return keep(*written(out, "fingerprints"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
