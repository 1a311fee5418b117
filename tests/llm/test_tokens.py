import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sievemill.llm import packing, token_counts

from . import cases

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = st.text(st.one_of(st.sampled_from(" \n\t'sdtmrevl.,!AZaz09é ñΣσςİß½日"), st.characters(exclude_categories=["Cs"])), max_size=60)


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD), packing.Encoder(BYTE), token_counts.Counter(WORD)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(ODD, min_size=1, max_size=5))
def test_ids_and_counts_are_the_library_s(libraries, texts):
    byte, word, encoder, counter = libraries
    ids, n = encoder.encode(texts)
    want = [e.ids for e in byte.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want
    assert counter.count(texts).tolist() == [len(e.ids) for e in word.encode_batch(texts, add_special_tokens=False)]


SPECIAL = st.lists(st.one_of(ODD, st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "\u0378", "\U0003134f", " "])), max_size=6).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(SPECIAL, min_size=1, max_size=4))
def test_strings_of_added_tokens_and_unassigned_code_points(libraries, texts):
    _, word, _, counter = libraries
    assert counter.count(texts).tolist() == [len(e.ids) for e in word.encode_batch(texts, add_special_tokens=False)]


def test_no_identifier_is_asked_for(libraries, monkeypatch):
    counter = token_counts.Counter(WORD)
    want = len(libraries[1].encode("a<|endoftext|>\u0378 b", add_special_tokens=False).ids)
    from tokenizers import Tokenizer

    class Without:
        def __init__(self, path):
            own = Tokenizer.from_file(path)
            self.normalizer, self.pre_tokenizer = own.normalizer, own.pre_tokenizer

    counter._library = Without(WORD)
    assert counter.count(["a<|endoftext|>\u0378 b"]).tolist() == [want]


def test_long_texts_in_segments(libraries, monkeypatch):
    byte, word, encoder, counter = libraries
    monkeypatch.setattr(packing, "SEGMENT", 5000)
    monkeypatch.setattr(token_counts, "SEGMENT", 5000)
    assert encoder.encode([cases.LONG])[0].tolist() == byte.encode(cases.LONG, add_special_tokens=False).ids
    assert counter.count([cases.LONG])[0] == len(word.encode(cases.LONG, add_special_tokens=False).ids)


def test_tables_begin_anew(libraries):
    byte = libraries[0]
    small = packing.Encoder(BYTE, kept=50)
    for s in range(5):
        t = cases.text(200, s)
        assert small.encode([t])[0].tolist() == byte.encode(t, add_special_tokens=False).ids


def test_merging_by_heap_is_merging_by_rank():
    ranks = {("a", "b"): 0, ("ab", "c"): 1, ("b", "c"): 2, ("c", "c"): 3, ("abc", "cc"): 4}
    assert token_counts.merged_length(list("abccc"), ranks) == 1
    assert token_counts.merged_length(list("aabb"), ranks) == 3
    assert token_counts.merged_length(["x"], ranks) == 1


@given(st.lists(st.integers(1, 20000), max_size=8))
def test_pieces_are_binary_digits(tokens):
    docs, start, length = packing.decomposed(np.array(tokens, np.int64))
    for i, n in enumerate(tokens):
        own = length[docs == i]
        assert own.sum() == n and all(x & (x - 1) == 0 and x <= 2048 for x in own.tolist())
        assert start[docs == i].tolist() == (np.cumsum(own) - own).tolist()
        assert len(set(own[own < 2048].tolist())) == (own < 2048).sum()


def test_packing_round_trip(spark, libraries):
    byte = libraries[0]
    rows = packing.pack(cases.documents(spark), BYTE).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    got = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and r.length == 2**r.bucket and r.offset == 0
        got.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    for i, t in cases.TEXTS:
        ids = [*byte.encode(t or "", add_special_tokens=False).ids, 1]
        whole = b"".join(x for _, x in sorted(got[(i, len(ids))]))
        assert whole[: 4 * len(ids)] == np.array(ids, "<u4").tobytes() or i == 12


def test_packing_query(spark, sf, libraries):
    byte = libraries[0]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = packing.op1_pack_power_of_two(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(docs)
    known = {i: np.array([*byte.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in docs.items()}
    assert sum(r.length for r in rows) == sum(map(len, known.values()))
    for r in rows:
        ids = known[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_buckets_are_folders(spark, tmp_path):
    packing.write_buckets(packing.pack(cases.documents(spark, cases.TEXTS[:3]), BYTE), str(tmp_path / "b"))
    assert all(p.name.startswith(("bucket=", "_", ".")) for p in (tmp_path / "b").iterdir())


def test_empty_tables(spark):
    none = cases.documents(spark, [])
    assert packing.pack(none, BYTE).count() == 0 and token_counts.count_tokens(none, WORD).count() == 0


def test_counts(spark, libraries):
    word = libraries[1]
    rows = token_counts.count_tokens(cases.documents(spark), WORD).collect()
    want = sorted((i or -1, len((t or "").encode()), len(word.encode(t or "", add_special_tokens=False).ids)) for i, t in cases.TEXTS)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == want
