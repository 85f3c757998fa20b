"""SimHash near-dedup with a generalised pigeonhole search.

The 64 bits are grouped into blocks of correlated bits, blocks are merged into partitions, and
every partition gets a threshold of its own. If the thresholds add up to (radius - partitions + 1),
a pair within the radius agrees up to its threshold in one partition at least; a threshold of -1
leaves a partition out. Dynamic programming picks partitions and thresholds from the candidates
that they would make, which are estimated from counts over all fingerprints.

A partition with threshold t is probed by masks: a key for each choice of t bits left out, so that
two fingerprints that differ in at most those bits share a key. Fingerprints that share a key are
verified in blocks of bounded size, and a block passes on a spanning forest of its links, never
all pairs. Equal fingerprints are one from the start, so copies cost nothing.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import materialise

from .batches import raw, slices, sums
from .components import components
from .tables import col, fresh

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS, BLOCK_BITS = 64, 16
#: Fingerprints verified together. A larger group is cut, and each pair of its cuts is verified.
GROUP_ROWS = 2048
#: What a key costs (made, moved, sorted) in units of one comparison.
KEY_COST = 64


def text_hashes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Hash of every shingle of words; a shorter text is one shingle, and a text without words none."""
    own = text.lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    joined = b" ".join(own)
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(own) - shingle + 1)
    last = ends[min(shingle, len(own)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)), np.uint64, n)


def fold_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints of runs of hashes: a bit is set if it is in over half of the run."""
    counts = np.zeros((len(offsets) - 1, BITS), np.int64)
    step = 1 << 16
    for lo in range(0, len(hashes), step):
        hi = min(lo + step, len(hashes))
        bits = np.unpackbits(hashes[lo:hi].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first, last = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, hi, "left")
        cut = np.clip(offsets[first : last + 1], lo, hi) - lo
        for k in range(first, last):
            counts[k] += bits[cut[k - first] : cut[k - first + 1]].sum(axis=0, dtype=np.int64)
    over = counts * 2 > np.diff(offsets)[:, None]
    return np.packbits(over, axis=1).view(">u8").astype(np.uint64).ravel()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; the fingerprint's 64 bits as a long. Texts without words have 0."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                own = [text_hashes(t) for t in raw(part["text"])]
                offsets = np.concatenate(([0], np.cumsum([len(h) for h in own])))
                found = fold_bits(np.concatenate(own), offsets).view(np.int64)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(found)], ["doc_id", "fingerprint"])

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, fingerprint long"
    return docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Partition:
    """Bit positions (0 is the lowest) and the threshold, 0 or more."""

    bits: tuple[int, ...]
    threshold: int

    def masks(self) -> list[int]:
        """Bits to keep for each key."""
        return [sum(1 << b for b in self.bits if b not in out) for out in map(set, itertools.combinations(self.bits, self.threshold))]


def bit_blocks(prints: DataFrame) -> list[tuple[int, ...]]:
    """Blocks of bits that go together: each takes the free bit with the strongest correlation, then those nearest to it."""

    def run(batches):
        both = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            x = batch["fingerprint"].to_numpy().view(np.uint64)
            for lo in range(0, len(x), 1 << 16):
                bits = ((x[lo : lo + (1 << 16), None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
        at = np.arange(BITS)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(at, BITS)), pa.array(np.tile(at, BITS)), pa.array(both.ravel())], ["a", "b", "n"])

    rows = prints.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((BITS, BITS))
    for r in rows:
        both[r["a"], r["b"]] = r["n"]
    n = max(1, prints.count())
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    near = np.abs(both / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(near, 0)
    free, out = set(range(BITS)), []
    while free:
        left = sorted(free)
        block = [max(left, key=lambda b: near[b, left].sum())]
        while len(block) < BLOCK_BITS:
            block.append(max((b for b in left if b not in block), key=lambda b: near[b, block].sum()))
        out.append(tuple(sorted(block)))
        free -= set(block)
    return out


def pair_shares(prints: DataFrame, blocks: list[tuple[int, ...]], radius: int) -> list[np.ndarray]:
    """For each block, the share of fingerprint pairs that differ in 0, 1, ... ``radius`` of its bits.

    From the counts of each block's values (2^16 at most) over all fingerprints: the Walsh-Hadamard
    transform turns them into the counts of all differences at once.
    """
    value = F.array(*(
        sum((F.shiftleft(F.shiftright("fingerprint", b).bitwiseAND(F.lit(1)), i) for i, b in enumerate(block)), F.lit(0).cast("long"))
        for block in blocks
    ))
    counted = prints.select(F.posexplode(value).alias("block", "value")).groupBy("block", "value").count().toArrow()
    weight = np.bitwise_count(np.arange(1 << BLOCK_BITS, dtype=np.uint32))
    shares = []
    for k in range(len(blocks)):
        own = counted.filter(pc.equal(counted["block"], k))
        x = np.zeros(1 << BLOCK_BITS)
        x[own["value"].to_numpy()] = own["count"].to_numpy()
        total = max(1.0, x.sum()) ** 2

        def transform(x):
            h = 1
            while h < len(x):
                x = x.reshape(-1, 2, h)
                x = np.stack([x[:, 0] + x[:, 1], x[:, 0] - x[:, 1]], axis=1)
                h *= 2
                x = x.reshape(-1)
            return x

        apart = np.maximum(transform(transform(x) ** 2) / len(x), 0)
        shares.append(np.bincount(weight, apart, BLOCK_BITS + 1)[: radius + 1] / total)
    return shares


def allocate(blocks: list[tuple[int, ...]], shares: list[np.ndarray], n: int, radius: int = RADIUS) -> list[Partition]:
    """Partitions (runs of blocks) and thresholds of the least estimated cost.

    Cost of a partition at threshold t: its candidates (pairs within t of each other there, blocks
    taken as independent) and its keys. Thresholds of m partitions add up to radius - m + 1, that
    is, each partition's (threshold + 1) to radius + 1. State: blocks used, radius used.
    """

    def cost(lo: int, hi: int, t: int) -> float:
        if t < 0:
            return 0.0
        share = np.ones(1)
        for s in shares[lo:hi]:
            share = np.convolve(share, s)[: radius + 1]
        keys = math.comb(sum(map(len, blocks[lo:hi])), t)
        return n * n * float(share[: t + 1].sum()) / 2 * (1 + t) + n * keys * KEY_COST

    best: dict[tuple[int, int], tuple[float, list[Partition]]] = {(0, 0): (0.0, [])}
    for hi in range(1, len(blocks) + 1):
        for used in range(radius + 2):
            options = []
            for lo in range(hi):
                bits = tuple(itertools.chain.from_iterable(blocks[lo:hi]))
                for t in range(-1, used):
                    if (lo, used - t - 1) in best:
                        c, chosen = best[lo, used - t - 1]
                        options.append((c + cost(lo, hi, t), chosen + [Partition(bits, t)] * (t >= 0)))
            if options:
                best[hi, used] = min(options, key=lambda o: o[0])
    return best[len(blocks), radius + 1][1]


def probe_keys(prints: DataFrame, partitions: list[Partition]) -> DataFrame:
    """(probe, key, fingerprint): for each mask the bits it keeps."""
    masks = np.array([m for p in partitions for m in p.masks()], dtype=np.uint64).view(np.int64)
    rows = max(1, (1 << 18) // len(masks))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                own = batch["fingerprint"][lo : lo + rows].to_numpy()
                key = (own[:, None] & masks).ravel()
                probe = np.tile(np.arange(len(masks), dtype=np.int32), len(own))
                yield pa.RecordBatch.from_arrays([pa.array(probe), pa.array(key), pa.array(np.repeat(own, len(masks)))], ["probe", "key", "fingerprint"])

    return prints.select("fingerprint").mapInArrow(run, "probe int, key long, fingerprint long")


def _forest(prints: np.ndarray, starts: np.ndarray, ends: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of each group ``starts[g]:ends[g]`` of ``prints``, as two positions.

    Compares each fingerprint with the one k places on, for rising k, while groups are that large.
    Each node points at a smaller one; roots of linked nodes are joined as links are found. Each link
    is a pair within ``radius`` that joined two trees.
    """
    parent = np.arange(len(prints))
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    group_end = np.repeat(ends, ends - starts)
    at = np.arange(len(prints))

    def roots(x):
        while True:
            up = parent[x]
            if (up == x).all():
                return x
            x = up

    k = 1
    while True:
        at = at[at + k < group_end[at]]
        if not len(at):
            break
        near = at[np.bitwise_count(prints[at] ^ prints[at + k]) <= radius]
        if len(near):
            a, b = near, near + k
            while len(a):
                x, y = roots(a), roots(b)
                differ = x != y
                a, b, upper, lower = a[differ], b[differ], np.maximum(x, y)[differ], np.minimum(x, y)[differ]
                np.minimum.at(parent, upper, lower)
                # One pair of those by which a root got its new parent.
                won = np.flatnonzero(parent[upper] == lower)
                won = won[np.unique(upper[won], return_index=True)[1]]
                kept.append((a[won], b[won]))
        k += 1
    if not kept:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([a for a, _ in kept]), np.concatenate([b for _, b in kept])


def links(prints: DataFrame, radius: int = RADIUS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b) links of distinct fingerprints that connect all pairs within ``radius``; not all pairs.

    ``prints`` is a written table with a column ``fingerprint`` without repeats.
    """
    n = max(1, prints.count())
    blocks = bit_blocks(prints)
    partitions = allocate(blocks, pair_shares(prints, blocks, radius), n, radius)
    keyed = probe_keys(prints, partitions)
    sizes = keyed.groupBy("probe", "key").count().where("count > 1")
    sizes = sizes.select(F.col("probe").alias("p"), F.col("key").alias("k"), F.ceil(F.col("count") / group_rows).cast("int").alias("cuts"))
    shared = keyed.join(sizes, (F.col("probe") == F.col("p")) & (F.col("key") == F.col("k")))
    # Cut c of m meets every cut: it goes to the cells (min, max) of itself and each other.
    cut = F.pmod(F.xxhash64("fingerprint", "probe"), F.col("cuts")).cast("int")
    shared = shared.withColumn("cut", cut).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    cell = shared.select("probe", "key", F.least("cut", "other").alias("cell_a"), F.greatest("cut", "other").alias("cell_b"), "fingerprint")
    keys = ["probe", "key", "cell_a", "cell_b"]
    dealt = cell.select(F.xxhash64(*keys).alias("cell"), "fingerprint").repartition("cell").sortWithinPartitions("cell")

    def verify(batches):
        rest_c, rest_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def told(c, f):
            bounds = np.flatnonzero(np.diff(c)) + 1
            starts, ends = np.concatenate(([0], bounds)), np.concatenate((bounds, [len(c)]))
            one, two = _forest(f.view(np.uint64), starts, ends, radius)
            return pa.RecordBatch.from_arrays([pa.array(f[one]), pa.array(f[two])], ["a", "b"])

        for batch in batches:
            c = np.concatenate((rest_c, batch["cell"].to_numpy()))
            f = np.concatenate((rest_f, batch["fingerprint"].to_numpy()))
            if not len(c):
                continue
            last = np.searchsorted(c, c[-1])  # the last group may go on in the next batch
            rest_c, rest_f = c[last:], f[last:]
            if last:
                yield told(c[:last], f[:last])
        if len(rest_c):
            yield told(rest_c, rest_f)

    return dealt.mapInArrow(verify, "a long, b long").where("a != b").distinct()


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    The component is the smallest id that is reached over links of fingerprints that differ in at
    most ``radius`` bits. Null, empty and wordless texts have fingerprint 0 and link like others.
    A null id takes part, but is never the smallest unless all of its component are null; repeated
    rows are answered each; other columns are not read; an empty table has no rows.
    """
    own = materialise(fingerprints(docs, doc_id, text))
    prints = materialise(own.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    found = materialise(links(prints, radius))
    parts = components(found, "a", "b").withColumnRenamed("node", "print_node")
    joined = prints.join(parts, F.col("fingerprint") == F.col("print_node"), "left")
    joined = joined.select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    best = joined.groupBy("component").agg(F.min("least").alias("component_id")).withColumnRenamed("component", "best_of")
    named = joined.join(best, F.col("component") == F.col("best_of")).select(F.col("fingerprint").alias("named"), "component_id")
    return own.join(named, F.col("fingerprint") == F.col("named")).select("doc_id", "fingerprint", "component_id")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each component stays: one of its smallest id. Columns stay.

    Of rows that share that id one stays, whichever; so does one row of a component of null ids.
    """
    row = fresh("dedup_row", docs)
    own = materialise(docs.select("*", F.monotonically_increasing_id().alias(row)))
    found = materialise(fingerprints(own.select(F.struct(col(doc_id).alias("id"), F.col(row).alias("row")).alias("who"), col(text).alias("text")), "who", "text"))
    # Ids before nulls, then rows: the least such pair stands for the document.
    order = F.struct(F.col("doc_id.id").isNull().alias("none"), F.col("doc_id.id").alias("id"), F.col("doc_id.row").alias("row"))
    prints = materialise(found.groupBy("fingerprint").agg(F.min(order).alias("least")))
    parts = components(materialise(links(prints.select("fingerprint"), radius)), "a", "b").withColumnRenamed("node", "print_node")
    joined = prints.join(parts, F.col("fingerprint") == F.col("print_node"), "left")
    kept = joined.groupBy(F.coalesce("component", "fingerprint")).agg(F.min("least.none").alias("none"), F.min("least").alias("least"))
    return own.join(kept.select(F.col("least.row").alias("kept_row")), F.col(row) == F.col("kept_row"), "left_semi").drop(row)
