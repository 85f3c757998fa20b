"""Work on Arrow batches of texts inside tasks: bounded slices, words as codes, packed arrays by section."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges whose texts hold about ``limit`` bytes; a longer text makes a slice of its own."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size) // limit
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, end in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
        yield batch.slice(int(start), int(end - start))


def raw(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null becomes empty."""
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


class Words(NamedTuple):
    """Words of several texts: ``vocab[codes[offsets[i]:offsets[i + 1]]]`` are those of text i."""

    codes: np.ndarray
    vocab: pa.Array
    offsets: np.ndarray


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Split at runs of ``[\\x20\\x09-\\x0D]``; ``lower`` turns A-Z to a-z. Null has no word."""
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, bounds = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    there = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate(([0], np.cumsum(there.to_numpy(zero_copy_only=False))))
    coded = flat.filter(there).dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, before[bounds])


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i + 1]]`` for each i; empty ranges give 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def sectioned(section: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """``values`` as bytes, one packed row for each section that occurs."""
    order = np.argsort(section, kind="stable")
    section, values = section[order], values[order]
    starts = np.flatnonzero(np.diff(section, prepend=-1))
    for start, end in zip(starts, np.append(starts[1:], len(section)), strict=True):
        yield int(section[start]), values[start:end].tobytes()
