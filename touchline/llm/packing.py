"""Best-fit packing into fixed-length sequences, certified by lower bounds.

Documents become token pieces of at most ``capacity``; only longer documents are cut. Pieces are
dealt into groups of bounded size by a hash, and each group is packed best-fit decreasing. Dual
feasible functions give a lower bound for every group, and, from the counts of each length, for
the whole table: a group at its bound is proven for itself, the table when all bins are as few as
its bound. Until then groups give up the bins with more free space than their median; these pieces
are dealt anew into fewer groups and packed again, as long as that saves bins.

A group reads lengths, not texts; its size does not depend on the table. The driver sees one
count for each length.
"""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import materialise

from .batches import slices, words
from .tables import col

CAPACITY = 2048
SEPARATOR = 0
GROUP_ROWS = 100_000
ROUNDS = 8

# Chunks of these characters are split and lower-cased here in the way of the tokenizer's own steps; all others,
# and those that may hold a special token, go through the whole tokenizer.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if visible, else one above 255."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ChunkIds:
    """Token ids of chunks without white space between them, remembered in bounded memory."""

    def __init__(self, path: str, remembered: int = 400_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = {i: c for i, c in _byte_letters().items()}
        self.known: dict[str, tuple[int, ...]] = {}
        self.remembered = remembered

    def part(self, part: str) -> tuple[int, ...]:
        ids = self.known.get(part)
        if ids is None:
            if len(self.known) >= self.remembered:
                self.known.clear()
            spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            ids = self.known[part] = tuple([t.id for t in self.model.tokenize(spelled)])
        return ids

    def chunk(self, chunk: str) -> tuple[int, ...]:
        if not _PLAIN.fullmatch(chunk) or "<|" in chunk:
            return tuple(self.whole.encode(chunk, add_special_tokens=False).ids)
        parts = _PARTS.findall(chunk.lower())
        return self.part(parts[0]) if len(parts) == 1 else tuple(itertools.chain.from_iterable(map(self.part, parts)))


@functools.cache
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(path)


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each text's begin and end."""
    codes, vocab, offsets = words(texts)
    own = [*map(chunk_ids(path).chunk, vocab.to_pylist())]
    length = np.fromiter(map(len, own), np.int64, len(own))
    flat = np.fromiter(itertools.chain.from_iterable(own), np.uint32, length.sum())
    start = np.cumsum(length) - length
    each = length[codes] if len(own) else np.zeros(0, np.int64)
    ends = np.concatenate(([0], np.cumsum(each)))
    place = np.repeat(start[codes] - ends[:-1], each) + np.arange(ends[-1]) if len(own) else np.zeros(0, np.int64)
    return flat[place], ends[offsets]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every piece of every row.

    A text's ids are followed by the separator, so null and empty texts are one piece of length 1.
    A null doc_id and repeated rows stay as they are. ``tokenizer`` is the path of a vocabulary file.
    """
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" * with_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = token_ids(part["text"], tokenizer)
                row, piece, start, length, crc, held = [], [], [], [], [], []
                for r in range(part.num_rows):
                    own = np.append(ids[offsets[r] : offsets[r + 1]], np.uint32(SEPARATOR)).astype("<u4")
                    for k, at in enumerate(range(0, len(own), capacity)):
                        cut = own[at : at + capacity]
                        row.append(r)
                        piece.append(k)
                        start.append(at)
                        length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                        if with_ids:
                            held.append(cut.astype(np.int32))
                arrays = [part["doc_id"].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
                arrays += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(held, pa.list_(pa.int32()))] * with_ids, names)

    return docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).mapInArrow(run, schema)


def lower_bound(counts: Mapping[int, int], capacity: int = CAPACITY) -> int:
    """No packing of these lengths needs fewer bins.

    Three families of dual feasible functions: the identity; for each threshold t up to half the
    capacity, dropping lengths below t and counting those above capacity - t as whole bins; and
    rounding (k + 1) * length / capacity down, over k. Any of them sums to a bound.
    """
    length = np.array(sorted(n for n in counts if n > 0), dtype=np.int64)
    if not len(length):
        return 0
    times = np.array([counts[n] for n in length.tolist()], dtype=object)
    if length[-1] > capacity:
        raise ValueError("a piece is longer than a sequence")

    def bins(size: np.ndarray, unit: int) -> int:
        return -(-int(sum(s * t for s, t in zip(size.tolist(), times, strict=True))) // unit)

    best = bins(length, capacity)
    for t in sorted({*length[length <= capacity // 2].tolist()}):
        size = np.where(length > capacity - t, capacity, np.where(length < t, 0, length))
        best = max(best, bins(size, capacity))
    for k in range(1, 21):
        whole = (k + 1) * length % capacity == 0
        size = np.where(whole, length * k, (k + 1) * length // capacity * capacity)
        best = max(best, bins(size, k * capacity))
    return best


def best_fit_decreasing(lengths: Iterable[int], capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the fill of each bin.

    Open bins are listed by free space; bit r of ``free`` says whether a bin with r free tokens is
    open, so the tightest fit is the lowest bit at or above the length.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    bins, offsets, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = free >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                free ^= 1 << space
        else:
            space, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        if space > n:
            by_space[space - n].append(b)
            free |= 1 << (space - n)
    return bins, offsets, np.array(fill, dtype=np.int64)


def _pack_groups(rows: DataFrame, round_: int, n: int, capacity: int, group_rows: int) -> DataFrame:
    """(uid, length, round, group, bin, offset, loose, excess): each group of (uid, length) packed by itself.

    ``loose`` bins may be exchanged; ``excess`` is the group's number of bins above its bound.
    """
    groups = max(1, -(-n // group_rows))
    dealt = rows.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(groups)).alias("group"))

    def pack(key, table):
        length = table["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(length, capacity)
        one, times = np.unique(length, return_counts=True)
        excess = len(fill) - lower_bound(dict(zip(one.tolist(), times.tolist(), strict=True)), capacity)
        loose = capacity - fill > np.median(capacity - fill)
        return pa.table(
            {
                "uid": table["uid"], "length": table["length"], "round": pa.array(np.full(len(bins), round_, np.int32)),
                "group": table["group"], "bin": pa.array(bins), "offset": pa.array(offsets),
                "loose": pa.array(loose[bins]), "excess": pa.array(np.full(len(bins), excess, np.int64)),
            }
        )

    schema = "uid long, length long, round int, group long, bin long, offset long, loose boolean, excess long"
    return dealt.groupBy("group").applyInArrow(pack, schema)


def _bins(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int = ROUNDS
) -> DataFrame:
    """(uid, sequence_id, offset) for rows (uid long, distinct; length long, 1 to ``capacity``).

    ``pieces`` is read several times, so it should be a written table. An empty table gives no row;
    equal lengths go by uid in any order. Full pieces have sequences of their own, with ids below 0.
    """
    full = pieces.where(F.col("length") == capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < capacity).select("uid", "length")
    counts = {r["length"]: r["count"] for r in part.groupBy("length").count().collect()}
    bound, waiting = lower_bound(counts, capacity), sum(counts.values())
    done: list[DataFrame] = []
    rows, kept = part, 0
    for round_ in range(rounds):
        packed = materialise(_pack_groups(rows, round_, waiting, capacity, group_rows))
        bins = _bins(packed)
        if round_ and bins >= before:
            break  # the exchange saved nothing: the last packing of these pieces stands
        if round_:
            done[-1] = done[-1].where("not loose")
        done.append(packed)
        loose = packed.where("loose")
        before = _bins(loose)
        kept += bins - before
        groups = packed.select("group").distinct().count()
        if kept + before <= bound or groups <= 1:
            break  # proven to be the fewest, or no other group to exchange with
        rows, waiting = loose.select("uid", "length"), loose.count()
    number = F.col("round").cast("long") * (1 << 56) + F.col("group") * (1 << 24) + F.col("bin")
    for packed in done:
        full = full.unionByName(packed.select("uid", number.alias("sequence_id"), "offset"))
    return full


def pack_documents(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row."""
    pieces = materialise(token_pieces(docs, tokenizer, doc_id, text, capacity).withColumn("uid", F.monotonically_increasing_id()))
    placed = pack_pieces(pieces, capacity).withColumnRenamed("uid", "placed_uid")
    return pieces.join(placed, F.col("uid") == F.col("placed_uid")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
