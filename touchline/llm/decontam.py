"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a window of tokens; it hashes the tokens under its ones and ignores
the others, so a window matches although ignored tokens were substituted. Windows of the
benchmark and of the corpus are hashed alike; a hit names a document, an item and their
alignment, which is then compared token by token around the hit.

The benchmark is taken in blocks of bounded size, each broadcast to one pass over the corpus, so
texts are never shuffled and a passage that very many documents hold costs each of them one
comparison.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from .batches import slices, words
from .tables import col, plain_names

SEEDS = ("11111", "1101011", "11100101", "10110011")
#: A passage is the same if so many tokens agree, 4 of 5 in the stretch they stand in, or all of a shorter item.
LEAST_OVERLAP = 10
MISMATCH = 4
#: Items of fewer tokens than the shortest seed cannot be told from chance.
SHORTEST = 5
BLOCK_TOKENS = 1_000_000
_FILTER_BITS = 22
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def token_hash(word: str) -> int:
    """Hash of a word in lower case without signs at its ends; 0 if nothing is left."""
    word = _EDGES.sub("", word.lower())
    return (xxhash.xxh64_intdigest(word.encode("utf-8", "replace")) | 1) if word else 0


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in a row, and the text of each."""
    codes, vocab, offsets = words(texts)
    own = np.fromiter(map(token_hash, vocab.to_pylist()), np.uint64, len(vocab))
    hashes = own[codes] if len(own) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return hashes[hashes != 0], row[hashes != 0]


def window_hashes(hashes: np.ndarray, row: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each window of one seed that lies in one text."""
    mask = SEEDS[seed]
    n = max(0, len(hashes) - len(mask) + 1)
    total = np.full(n, seed + 1, np.uint64)
    for j, one in enumerate(mask):
        if one == "1":
            total = (total ^ hashes[j : n + j]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
    start = np.flatnonzero(row[:n] == row[len(mask) - 1 : n + len(mask) - 1])
    return total[start], start


@dataclass(frozen=True)
class Block:
    """Some items: tokens of all in a row, where each begins, and the windows of all seeds sorted by hash."""

    ids: list
    hashes: np.ndarray
    starts: np.ndarray
    windows: np.ndarray
    at: np.ndarray
    item: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[str]) -> Block:
        hashes, row = tokens(pa.array(texts, pa.string()))
        starts = np.searchsorted(row, np.arange(len(ids) + 1))
        found, at = zip(*(window_hashes(hashes, row, s) for s in range(len(SEEDS))), strict=True)
        found, at = np.concatenate(found), np.concatenate(at)
        order = np.argsort(found)
        return cls(ids, hashes, starts, found[order], at[order], row[at[order]])

    def filter(self) -> np.ndarray:
        there = np.zeros(1 << _FILTER_BITS, bool)
        there[self.windows >> np.uint64(64 - _FILTER_BITS)] = True
        return there


def blocks(benchmark: DataFrame, item_id: str, text: str, block_tokens: int) -> Iterator[Block]:
    """The items in blocks of about so many characters' worth of tokens; a longer item is a block of its own."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(col(item_id).alias("id"), col(text).alias("text")).where("text is not null").toLocalIterator():
        ids.append(r["id"])
        texts.append(r["text"])
        size += len(r["text"]) // 4 + 1
        if size >= block_tokens:
            yield Block.of(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Block.of(ids, texts)


def agreement(doc: np.ndarray, item: np.ndarray, shift: int) -> np.ndarray:
    """Positions of the item that agree in the longest stretch of one alignment in which 4 of 5 tokens agree."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    same = doc[lo + shift : hi + shift] == item[lo:hi]
    total = np.concatenate(([0], np.cumsum(np.where(same, 1, -MISMATCH))))
    # For each end the first begin whose total is not higher; running minima only fall.
    first = np.searchsorted(-np.minimum.accumulate(total), -total, "left")
    end = int((np.arange(len(total)) - first).argmax())
    begin = int(first[end])
    return lo + begin + np.flatnonzero(same[begin:end])


def overlaps(texts: pa.Array, block: Block, there: np.ndarray, least: int) -> list[tuple[int, int, int, int, int, int]]:
    """(text, item, tokens in agreement, tokens of the item, first and last token in the text) of each pair that overlaps."""
    hashes, row = tokens(texts)
    begin = np.searchsorted(row, np.arange(len(texts) + 1))
    found = []
    for s in range(len(SEEDS)):
        window, start = window_hashes(hashes, row, s)
        near = np.flatnonzero(there[window >> np.uint64(64 - _FILTER_BITS)])
        left = np.searchsorted(block.windows, window[near], "left")
        many = np.searchsorted(block.windows, window[near], "right") - left
        place = np.repeat(left - (np.cumsum(many) - many), many) + np.arange(many.sum())
        start = np.repeat(start[near], many)
        shift = (start - begin[row[start]]) - (block.at[place] - block.starts[block.item[place]])
        found.append(np.stack([row[start], block.item[place], shift], axis=1))
    pairs: dict[tuple[int, int], tuple[set, int, int]] = {}
    for text, item, shift in sorted(set(map(tuple, np.concatenate(found).tolist()))):
        own, target = hashes[begin[text] : begin[text + 1]], block.hashes[block.starts[item] : block.starts[item + 1]]
        agreed = agreement(own, target, shift)
        if len(agreed) >= SHORTEST:
            held, first, last = pairs.get((text, item), (set(), len(own), 0))
            pairs[text, item] = held | set(agreed.tolist()), min(first, shift + int(agreed[0])), max(last, shift + int(agreed[-1]))
    told = []
    for (text, item), (held, first, last) in pairs.items():
        n = int(block.starts[item + 1] - block.starts[item])
        if len(held) >= min(least, n):
            told.append((text, item, len(held), n, first, last))
    return told


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: int = LEAST_OVERLAP,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """(doc_id, item_id, overlap, item_tokens, first_token, last_token): documents that hold a benchmark passage.

    ``overlap`` counts the item's tokens found in the document, in stretches in which 4 of 5 agree;
    a pair is reported from ``least`` tokens on, or if a shorter item is there in full. Null and
    empty texts, and items of fewer than five tokens, take part in no pair; a null id stays null;
    each of repeated rows is reported. Tokens are words in lower case without signs at their ends.
    """
    spark = docs.sparkSession
    types = docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = "doc_id {}, item_id {}, overlap long, item_tokens long, first_token long, last_token long".format(*types)
    id_type = to_arrow_type(benchmark.schema[item_id].dataType)
    own = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark, item_id, item_text, block_tokens):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            block = shared.value
            there = block.filter()
            for batch in batches:
                for part in slices(batch, "text"):
                    found = overlaps(part["text"], block, there, least)
                    if found:
                        text, item, *counts = zip(*found, strict=True)
                        ids = pa.array([block.ids[i] for i in item], id_type)
                        yield pa.RecordBatch.from_arrays(
                            [part["doc_id"].take(pa.array(text, pa.int64())), ids, *(pa.array(c, pa.int64()) for c in counts)],
                            ["doc_id", "item_id", "overlap", "item_tokens", "first_token", "last_token"],
                        )

        out = out.unionByName(own.mapInArrow(run, schema))
    return out


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: int = LEAST_OVERLAP,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, by the rule of ``contaminated``."""
    left, names = plain_names(docs)
    body = names[docs.columns.index(text)]
    for block in blocks(benchmark, item_id, item_text, block_tokens):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            block = shared.value
            there = block.filter()
            for batch in batches:
                for part in slices(batch, body):
                    keep = np.ones(part.num_rows, bool)
                    keep[[t for t, *_ in overlaps(part[body], block, there, least)]] = False
                    yield part.filter(pa.array(keep))

        left = left.mapInArrow(run, left.schema)
    return left.toDF(*docs.columns)
