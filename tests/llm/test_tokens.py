"""Token files, BPE digests and packing on the odd corpus."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from yieldline.llm import bpe, eliasfano, packing
from yieldline.llm.eliasfano import Block, EliasFano, StoredBlock
from yieldline.llm.encoding import ForcedBoundaryEncoder, LowerCaseWordEncoder, vocabulary_path
from yieldline.session import new_folder

BYTES, WORDS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("word_bpe_49k.json")


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.fixture(scope="module")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.collect()]


@settings(max_examples=80, deadline=None)
@given(values=st.lists(st.integers(0, 2**40), max_size=300))
def test_elias_fano_round_trip_and_select(values):
    values = np.sort(np.array(values, np.uint64))
    stored, used = EliasFano.from_bytes(memoryview(EliasFano.of(values).to_bytes()))
    assert stored.all().tolist() == values.tolist()
    assert [stored.select(i) for i in range(len(values))] == values.tolist()
    assert used == len(EliasFano.of(values).to_bytes())


def test_elias_fano_needs_about_two_bits_more_than_the_gap():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 1000, 5000))
    assert 8 * len(EliasFano.of(ends).to_bytes()) / 5000 < np.log2(ends[-1] / 5000) + 3.2


def test_block_reads_one_document_alone():
    block = Block([None, -5, 3, 3], np.array([2, 2, 5, 6]), np.array([9, 8, 7, 6, 5, 4]))
    stored = StoredBlock(block.to_bytes(2))
    assert stored.keys() == [None, -5, 3, 3]
    assert [stored.document(i).tolist() for i in range(4)] == [[9, 8], [], [7, 6, 5], [4]]


def test_token_files(spark, documents, rows, monkeypatch):
    library = LowerCaseWordEncoder(WORDS).library
    folder = new_folder(spark, "tokens")
    eliasfano.write(documents, folder, WORDS)
    index = [tuple(r) for r in eliasfano.read_index(spark, folder).collect()]
    want, at = Counter(), 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for key, text in order:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want[key, at, len(ids), zlib.crc32(packed(ids))] += 1
        at += len(ids)
    assert Counter(index) == want
    tokens = Counter((r.doc_id, tuple(r.ids)) for r in eliasfano.read_tokens(spark, folder).collect())
    assert tokens == Counter((k, tuple(library.encode(t or "", add_special_tokens=False).ids + [2])) for k, t in order)


def test_no_documents_no_tokens(spark, nothing):
    folder = new_folder(spark, "tokens")
    eliasfano.write(nothing, folder, WORDS)
    assert eliasfano.read_index(spark, folder).count() == 0
    assert packing.pack(nothing, BYTES).count() == 0
    assert bpe.round_trip_digests(nothing, BYTES).count() == 0


def test_bpe_digests_and_round_trip(documents, rows):
    library = ForcedBoundaryEncoder(BYTES).library
    want = Counter()
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False).encode()
        want[key, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(back).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe.round_trip_digests(documents, BYTES).collect()) == want
    again = bpe.decode(bpe.encode(documents, BYTES), BYTES)
    assert again.columns == [*documents.columns, "ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in again.collect())


@pytest.mark.parametrize("size, windows", [(2048, 64), (50, 3)])
def test_packing_places_every_id_once(documents, rows, size, windows):
    library = ForcedBoundaryEncoder(BYTES).library
    pieces = packing.pack(documents, BYTES, size=size, open_windows=windows).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size
    want = Counter()
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for a in range(0, len(ids), size):
            want[key, a, len(ids[a : a + size]), zlib.crc32(packed(ids[a : a + size])), len(ids)] += 1
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == want


def test_windows_stay_bounded_and_close_the_fullest():
    windows = packing.OpenWindows(10, 2)
    assert [windows.place(n) for n in (6, 7, 3, 5, 5, 4)] == [(0, 0), (1, 0), (1, 7), (2, 0), (2, 5), (0, 6)]
    assert len(windows.free) <= 2
