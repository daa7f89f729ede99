"""Token counts, ids and packing against the tokenizer library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from railwatch.llm import bpe, packing
from railwatch.llm.blocks import slabs
from railwatch.llm.queries import QUERIES, vocabulary
from railwatch.llm.tokens import token_counts
from tests.llm.samples import no_docs, odd_docs

SF = "/root/testdata/sf0.001"
TEXTS = [
    "", "it's we'll  they've 'tis ''s !'s 's'll \n's x  y", "a\n\n b \t\tc  ", "<|endoftext|>a <|endoftext|> <|endoftext|>",
    "日本語 тест 123½ ①x", "==" * 300, "ab" * 400, " " * 50 + "x", "é 😀😀 ok", "x'rex 'vE 'LL I'M", "\r\n\r\n", "don't'll", "ÃÂ" * 70,
    "'", "''", " '", " ", "\u3000 a\u00a0b",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def ids_of(texts, limit=1 << 21):
    machine, out = bpe.encoder(vocabulary(), True), []
    for slab in slabs(pa.array(texts, pa.string()), limit):
        counts, flat = machine.ids(slab)
        assert machine.count(slab).tolist() == counts.tolist()
        ends = np.cumsum(counts)
        out += [flat[e - c:e].tolist() for e, c in zip(ends, counts, strict=True)]
    return out


@pytest.mark.parametrize("limit", [1, 64, 1 << 21])
def test_ids_equal_the_library(library, limit):
    assert ids_of(TEXTS, limit) == [library.encode(t, add_special_tokens=False).ids for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("'stmdrevl aA1 \n\t!-é日"), st.characters(codec="utf-8", exclude_categories=["Cn", "Cs"]))), max_size=5))
def test_any_text(library, texts):
    assert ids_of(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_chunk_maps_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    points = rng.choice(np.frombuffer("ab1 '!s\nre".encode(), np.uint8), 5_000).astype(np.uint32)
    heads = rng.random(5_000) < 0.01
    heads[0] = True
    kind, state, want = bpe._symbols(points, heads), bpe.START, []
    for k, head in zip(kind.tolist(), heads.tolist(), strict=True):
        symbol = k + 9 * head
        want.append(bool(bpe._BEGINS[symbol, state]))
        state = int(bpe._TO[symbol, state])
    assert bpe.piece_starts(points, heads).tolist() == want


def test_table_is_emptied_when_full(library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_BITS", 6)
    machine, texts = bpe.Encoder(vocabulary(), True), [f"word{i} x{i * i}" for i in range(300)]
    for slab in slabs(pa.array(texts), 400):
        got = machine.count(slab).tolist()
        assert got == [len(library.encode(t).ids) for t in texts[slab.first:slab.last]]
    assert machine.used <= 1 << (machine.bits - 1)
    small = next(slabs(pa.array(["a b"])))
    for _ in range(40):
        machine.count(small)
    assert machine.bits < 12


def test_query_counts_every_text(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_token_counts"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)


def test_odd_rows_are_counted(spark, library):
    docs = odd_docs(spark)
    want = sorted((str(r.doc_id), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    got = sorted((str(r.doc_id), r.n_tokens) for r in token_counts(docs, vocabulary()).collect())
    assert got == want
    assert token_counts(no_docs(spark), vocabulary()).collect() == []


def check_packing(rows, texts, library, limit=1024):
    """Every id once and in place, no sequence over the limit, offsets gapless."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 2]
        at = 0
        for i, p in enumerate(sorted(parts, key=lambda p: p.piece)):
            assert (p.piece, p.start) == (i, at)
            assert p.length == limit if i else p.length <= limit
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limit
    return len(by_sequence)


def test_query_packs_every_text(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_pack_sequences"](spark, SF).collect()
    bins = check_packing(rows, docs, library)
    total = sum(r.length for r in rows)
    over_half = sum(r.length > 512 for r in rows)
    assert bins <= 1.03 * max(-(-total // 1024), over_half) + 1


def test_odd_rows_are_packed(spark, library):
    docs = odd_docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    packed = packing.pack(docs, vocabulary(), keep_ids=True)
    rows = packed.withColumnRenamed("check", "ids_crc32").collect()
    check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, library)
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack(odd_docs(spark), vocabulary()).where("doc_id IS NULL").count() == 2
    assert packing.pack(no_docs(spark), vocabulary()).collect() == []


def test_search_empties_a_bin_that_best_fit_leaves():
    # Best fit gives {4, 4}, {3, 3, 3}, {3}; one exchange of 4 and 3 makes room for the last.
    lengths = np.array([4, 4, 3, 3, 3, 3], np.int64)
    at, bins = packing.best_fit(lengths, 10)
    assert bins == 3
    better = packing.empty_bins(lengths, at, bins, 10)
    fill = np.bincount(better, weights=lengths)
    assert fill.max() <= 10 and len(np.unique(better)) == 2


def test_search_exchanges_any_two_pieces():
    lengths = np.array([33, 6, 27, 6, 5, 15, 14, 2, 20], np.int64)
    at, bins = packing.best_fit(lengths, 64)
    assert bins == 3 and lengths.sum() == 2 * 64
    assert len(np.unique(packing.empty_bins(lengths, at, bins, 64))) == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_blocks_are_packed_within_their_limit(lengths):
    lengths = np.array(lengths, np.int64)
    at, offset, bins = packing.pack_block(lengths, 64)
    assert len(np.unique(at)) == bins
    for b in range(bins):
        own = np.flatnonzero(at == b)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist()
        assert lengths[own].sum() <= 64
    first, plain = packing.best_fit(lengths, 64)
    assert bins <= plain


def test_long_pieces_and_colliding_hashes_equal_the_library(library, monkeypatch):
    """Words of any length go through the transducer in chunks; a hash alone never decides."""
    rng = random.Random(1)
    bits = "".join("ab"[i.bit_count() % 2] for i in range(4096))
    texts = [bits[:1024] + " " + bits[:1024].translate(str.maketrans("ab", "ba")), bits, bits.translate(str.maketrans("ab", "ba"))]
    texts += ["a" * n for n in (97, 128, 129, 5_000)] + ["the" * 500, "=" * 3_000 + "-" * 500, " " * 4_000, "\n" * 700, "的一是不了" * 300]
    texts += ["".join(rng.choices(letters, k=rng.randrange(90, 3_000))) for letters in ("ab", "abcdefghijklmnopqrstuvwxyz") for _ in range(20)]
    texts += ["".join(rng.choice(["the", "and", "ing", "tion", "ed"]) for _ in range(rng.randrange(30, 900))) for _ in range(20)]

    def same(machine, some):
        at = 0
        for slab in slabs(pa.array(some)):
            count, flat = machine.ids(slab)
            ends = np.r_[0, np.cumsum(count)]
            for row in range(slab.rows):
                assert flat[ends[row]:ends[row + 1]].tolist() == library.encode(some[at], add_special_tokens=False).ids
                at += 1

    same(bpe.Encoder(vocabulary(), True), texts)
    monkeypatch.setattr(bpe, "TABLE_BYTES", 4_000)
    same(bpe.Encoder(vocabulary(), True), texts[:30] + ["some words and more words"] * 3)
    monkeypatch.setattr(bpe, "span_hashes", lambda data, start, end: ((end - start) % 5).astype(np.uint64))
    same(bpe.Encoder(vocabulary(), True), ["it is what it was, and who would say not", "who it was"])
