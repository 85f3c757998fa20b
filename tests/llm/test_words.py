"""Helpers on Arrow batches."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import batches

ODD = [None, "", " ", "a", "A b\tc\nd\x0be\x0cf\rg", "\x1ca\x1d b\x85c d", "é É ẞ", "  x  y  ", "w" * 10_000]


@pytest.mark.parametrize("lower", [False, True])
def test_words_are_split_at_six_characters_only(lower):
    found = batches.words(pa.array(ODD, pa.string()), lower)
    vocab = found.vocab.to_pylist()
    for text, lo, hi in zip(ODD, found.offsets, found.offsets[1:]):
        own = (text or "").encode()
        own = (own.lower() if lower else own).split()
        assert [vocab[c].encode() for c in found.codes[lo:hi]] == own


def test_words_of_a_cut_array():
    texts = pa.array(["a b", "c", "d e f", None])
    found = batches.words(texts.slice(1, 2))
    assert [found.vocab[c].as_py() for c in found.codes] == ["c", "d", "e", "f"]
    assert found.offsets.tolist() == [0, 1, 4]


def test_slices_hold_every_row_once_and_long_texts_alone():
    texts = ["x" * n for n in (0, 10, 0, 500, 3, 3, 900, 0)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([*texts, None])})
    parts = list(batches.slices(batch, "text", 100))
    assert [t for p in parts for t in p["text"].to_pylist()] == [*texts, None]
    assert max(sum(len(t or "") for t in p["text"].to_pylist()) for p in parts) <= 1000
    assert len(parts) >= 3 and not list(batches.slices(batch.slice(0, 0), "text"))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(-5, 5), max_size=5), max_size=6))
def test_sums(groups):
    values = np.array([v for g in groups for v in g], dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum([len(g) for g in groups]))).astype(np.int64)
    assert batches.sums(values, offsets).tolist() == [sum(g) for g in groups]


def test_sectioned_keeps_values_by_section():
    section, values = np.array([2, 0, 2, 1]), np.array([7, 8, 9, 10], dtype=np.uint64)
    found = {s: np.frombuffer(b, np.uint64).tolist() for s, b in batches.sectioned(section, values)}
    assert found == {0: [8], 1: [10], 2: [7, 9]}
