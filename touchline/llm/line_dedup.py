"""Line deduplication across documents with two Bloom filters.

Pass one hashes every line key. A once-seen filter takes every hash; a hash that is in it
already goes to the twice-seen filter. Pass two tests every line against the twice-seen filter,
and only the suspects leave their task: their texts are grouped exactly, which drops the false
ones and picks the smallest document that holds each key.

The filters are built in sections, each by one task that streams the hashes of its section
(packed arrays, eight bytes a line) through fixed memory. The twice-seen filter has at most
``filter_bits`` bits, the bound under which it is broadcast; beyond what it was sized for, more
lines are suspected, never fewer, and the result stays exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import materialise

from .batches import raw, sectioned, slices
from .tables import col, fresh, plain_names

SECTIONS = 256
FILTER_BITS = 1 << 28
#: Least and wanted filter size; the largest id stands for a null one.
LEAST_BITS, BITS_A_LINE, PROBES = 1 << 18, 12, 4
NULL_ID = 2**63 - 1


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def long_enough(key: bytes, least: int) -> bool:
    """At least so many code points, which take one to four bytes each."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def keys_of(text: bytes, least: int) -> set[bytes]:
    return {k for k in map(line_key, text.split(b"\n")) if long_enough(k, least)}


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit places of each hash in a filter of ``bits`` (a power of two), one column a probe."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _section(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(56)).astype(np.int64) % SECTIONS


def hash_lines(docs: DataFrame, least: int) -> DataFrame:
    """(section, hashes): packed hashes of the keys of each slice of texts, twice where two of its documents hold a key."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                by_id: dict[int, set[bytes]] = {}
                for i, text in zip(part["id"].to_pylist(), raw(part["text"]), strict=True):
                    by_id.setdefault(i, set()).update(keys_of(text, least))
                found = np.fromiter((xxhash.xxh64_intdigest(k) for s in by_id.values() for k in s), dtype=np.uint64)
                if len(found):
                    one, times = np.unique(found, return_counts=True)
                    both = np.repeat(one, np.minimum(times, 2))
                    packed = list(sectioned(_section(both), both))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s for s, _ in packed], pa.int32()), pa.array([b for _, b in packed], pa.binary())],
                        ["section", "hashes"],
                    )

    return docs.mapInArrow(run, "section int, hashes binary")


def twice_filter(hashed: DataFrame, bits: int) -> DataFrame:
    """(section, filter): bits of the twice-seen filter, for sections that have any."""
    own = bits // SECTIONS

    def run(batches):
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, packed in zip(batch["section"].to_pylist(), batch["hashes"].to_pylist(), strict=True):
                seen = once.setdefault(s, np.zeros(own, dtype=bool))
                one, times = np.unique(np.frombuffer(packed, dtype=np.uint64), return_counts=True)
                at = _probes(one, own)
                again = seen[at].all(axis=1) | (times > 1)
                if again.any():
                    twice.setdefault(s, np.zeros(own, dtype=bool))[at[again]] = True
                seen[at] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(twice), pa.int32()), pa.array([np.packbits(x).tobytes() for x in twice.values()], pa.binary())],
            ["section", "filter"],
        )

    return hashed.repartition("section").mapInArrow(run, "section int, filter binary")


def suspects(docs: DataFrame, filters: dict[int, bytes], bits: int, least: int) -> DataFrame:
    """(id, key, digest): the keys that the twice-seen filter holds, once for each row."""
    own = bits // SECTIONS
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        held = shared.value
        table = np.zeros((SECTIONS, own // 8), dtype=np.uint8)
        for s, packed in held.items():
            table[s] = np.frombuffer(packed, dtype=np.uint8)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, keys = [], []
                for i, text in zip(part["id"].to_pylist(), raw(part["text"]), strict=True):
                    own_keys = keys_of(text, least)
                    keys += own_keys
                    ids += [i] * len(own_keys)
                if not keys:
                    continue
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))
                at = _probes(hashes, own)
                bit = table[_section(hashes)[:, None], at >> 3] >> (7 - (at & 7)).astype(np.uint8)
                hit = np.flatnonzero((bit & 1).all(axis=1))
                chosen = [keys[j] for j in hit]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[j] for j in hit], pa.int64()),
                        pa.array(chosen, pa.binary()),
                        pa.array([key_digest(k) for k in chosen], pa.binary()),
                    ],
                    ["id", "key", "digest"],
                )

    return docs.mapInArrow(run, "id long, key binary, digest binary")


def key_digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def dropped_keys(docs: DataFrame, least: int, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(id, drops): for documents that lose lines, the digests of the keys they lose."""
    hashed = materialise(hash_lines(docs, least))
    lines = hashed.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0
    bits = min(filter_bits, max(LEAST_BITS, 1 << int(lines // 8 * BITS_A_LINE).bit_length()))
    filters = {r["section"]: bytes(r["filter"]) for r in twice_filter(hashed, bits).toLocalIterator()}
    found = materialise(suspects(docs, filters, bits, least))
    exact = found.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # Written, so that both sides of the join are plain exchanges, which Spark can split where one line is in very many documents.
    exact = materialise(exact.where("first < last").select(F.col("key").alias("repeated"), "first"))
    lost = found.join(exact, (F.col("key") == F.col("repeated")) & (F.col("id") > F.col("first")))
    return lost.groupBy("id").agg(F.collect_set("digest").alias("drops"))


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = 10,
    stats: str | None = None,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``; columns and rows stay.

    A line's key is the line without white space around it, A-Z in lower case. A key of at least
    ``least`` code points in two documents or more loses its lines in all but the smallest id.
    Other lines stay, joined by ``\\n``. Rows of one id are one document; null ids count as one
    document after all others. Null text stays null and counts as one empty line. ``stats`` names a
    column to add (replacing one of that name): struct (n_lines, n_dropped, kept_sha256).
    """
    key = F.coalesce(col(doc_id).cast("long"), F.lit(NULL_ID))
    body = docs.select(key.alias("id"), col(text).alias("text"))
    drops = dropped_keys(body, least, filter_bits)
    at, lost, drop_id = fresh("line_doc", docs), fresh("line_drops", docs), fresh("line_drop_doc", docs)
    drops = drops.select(F.col("id").alias(drop_id), F.col("drops").alias(lost))
    joined = docs.withColumn(at, key).join(drops, F.col(at) == F.col(drop_id), "left").drop(at, drop_id)
    kept = [c for c in docs.columns if stats is None or c.lower() != stats.lower()]
    joined, plain = plain_names(joined.select(*map(col, kept), col(lost)))
    body, gone_at = plain[kept.index(text)], plain[-1]
    # One pass gives text and counts; the counts travel beside the other columns.
    counts = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])
    schema = joined.drop(gone_at).schema
    if stats:
        schema = schema.add("stats", T.StructType.fromDDL("n_lines long, n_dropped long, kept_sha256 string"))
    names = schema.names

    def run(batches):
        for batch in batches:
            for part in slices(batch, body):
                texts, told = [], []
                for own, gone in zip(raw(part[body]), part[gone_at].to_pylist(), strict=True):
                    lines = own.split(b"\n")
                    stay = lines
                    if gone:
                        gone = set(gone)
                        stay = [x for x in lines if not (long_enough(k := line_key(x), least) and key_digest(k) in gone)]
                    out = b"\n".join(stay)
                    texts.append(out)
                    if stats:
                        told.append((len(lines), len(lines) - len(stay), hashlib.sha256(out).hexdigest()))
                arrays = [part[c] for c in plain[:-1]]
                arrays[plain.index(body)] = pa.array(
                    [x if ok else None for x, ok in zip(texts, part[body].is_valid().to_pylist(), strict=True)], pa.binary()
                ).cast(pa.string())
                if stats:
                    fields = [pa.array(x, t.type) for x, t in zip(zip(*told, strict=True), counts, strict=True)]
                    arrays.append(pa.StructArray.from_arrays(fields, [t.name for t in counts]))
                yield pa.RecordBatch.from_arrays(arrays, names)

    return joined.mapInArrow(run, schema).toDF(*kept, *[stats] * bool(stats))
