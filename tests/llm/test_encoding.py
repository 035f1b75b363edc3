"""Token ids against the tokenizers library, text by text."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from yieldline.llm.columns import slices
from yieldline.llm.encoding import ForcedBoundaryEncoder, LowerCaseWordEncoder, vocabulary_path

BYTES = ForcedBoundaryEncoder(vocabulary_path("byte_bpe_50k.json"))
WORDS = LowerCaseWordEncoder(vocabulary_path("word_bpe_49k.json"))
ALPHABET = list("ab stdmlrve''!?.\n\n\t  09é Éß×·²ÀÿœΣςİ字  \x85\x1c\x0b") + ["<|endoftext|>", "'re", "'ll", "'S", "don't", "  ", "\r\n"]


def check(encoder, texts):
    ids, offsets = encoder.column(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want = encoder.library.encode(text or "", add_special_tokens=False).ids
        assert ids[offsets[i] : offsets[i + 1]].tolist() == want, text


@pytest.mark.parametrize("encoder", [BYTES, WORDS])
def test_odd_texts(encoder):
    rng = random.Random(5)
    odd = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    check(encoder, [*odd, "", None, "x" * 5000, " " * 3000, "é'" * 500])


@pytest.mark.parametrize("encoder", [BYTES, WORDS])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=6))
def test_any_texts(encoder, texts):
    check(encoder, texts)


def test_a_cut_needs_a_pair_that_no_token_has():
    data = np.frombuffer(b"the cat", np.uint8)
    parts, count = BYTES.fragments(data, np.array([0, len(data)]))
    assert parts.to_pylist() == ["the", " cat"] and count.tolist() == [2]


def test_decode_gives_the_text_back():
    texts = ["", "Grüße, 字!", "<|endoftext|> x", None]
    ids, offsets = BYTES.column(pa.array(texts, pa.string()))
    assert [t.decode() for t in BYTES.decoded(ids, offsets)] == [t or "" for t in texts]


def test_slices_keep_every_row_once():
    batch = pa.record_batch({"text": pa.array(["a" * 10, "", None, "b" * 100, "c", "d" * 30])})
    parts = list(slices(iter([batch]), "text", 35))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert max(sum(len(t or "") for t in p.column(0).to_pylist()) for p in parts) == 100
