"""SimHash classes against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import components, simhash
from touchline.llm.queries import op1_simhash

from .conftest import ODD, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    own = WORD.findall(text)
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def class_of(prints, radius=3):
    """Least position reached from each fingerprint."""
    prints = np.array(prints, dtype=np.uint64)
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius) + i + 1:
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_odd_rows(odd):
    rows = sorted(((r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in simhash.classes(odd).collect()), key=str)
    order = sorted(ODD, key=lambda r: (r[0] is None, r[0] or 0))
    prints = [fingerprint(r[1]) for r in order]
    exp = [(r[0], p, order[c][0]) for r, p, c in zip(order, prints, class_of(prints), strict=True)]
    assert rows == sorted(exp, key=str)


def test_empty_table(none):
    assert simhash.classes(none).count() == 0 and simhash.near_dedup(none).count() == 0


def test_one_document_of_each_class_stays(odd):
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns
    prints = [fingerprint(r[1]) for r in ODD]
    exp = {}
    for r, c in zip(ODD, class_of(prints), strict=True):
        exp.setdefault(c, []).append((r[0] is None, r[0]))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(min(v, key=lambda x: (x[0], x[1] or 0))[1]) for v in exp.values())


def test_bits_fold_over_slices():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 200_000).astype(np.uint64)
    offsets = np.array([0, 0, 5, 70_000, 70_000, 199_999, 200_000, 200_000])
    for got, lo, hi in zip(simhash.fold_bits(hashes, offsets), offsets, offsets[1:]):
        own = hashes[lo:hi]
        bits = ((own[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0) * 2 > hi - lo
        assert int(got) == sum(1 << b for b in range(64) if bits[b])


def near_groups(seed, n):
    """Random fingerprints, some with neighbours at 1 to 4 bits, and chains of such steps; two bits are always equal."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64) & ~(1 << 40) | (1 << 7)
        for _ in range(rng.choice([1, 1, 1, 4, 60])):
            out.add(x)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize(("seed", "group_rows"), [(1, 2048), (2, 7)])
def test_links_connect_what_all_pairs_connect(spark, seed, group_rows):
    prints = near_groups(seed, 3000)
    signed = [(x - 2**64 if x >> 63 else x,) for x in prints]
    found = simhash.links(spark.createDataFrame(signed, "fingerprint long"), group_rows=group_rows)
    place = {x: i for i, (x,) in enumerate(signed)}
    links = [(place[r["a"]], place[r["b"]]) for r in found.collect()]
    own = np.array(prints, dtype=np.uint64)
    assert all(np.bitwise_count(own[a] ^ own[b]) <= simhash.RADIUS for a, b in links)
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert [root(i) for i in range(len(prints))] == class_of(prints)


@pytest.mark.parametrize("n", [10, 10**6, 10**9, 10**12])
def test_thresholds_cover_the_radius_at_every_size(n):
    blocks = [tuple(range(i, i + 16)) for i in range(0, 64, 16)]
    shares = [np.array([2.0**-16, 16 * 2.0**-16, 120 * 2.0**-16, 560 * 2.0**-16])] * 4
    chosen = simhash.allocate(blocks, shares, n)
    assert sum(p.threshold + 1 for p in chosen) == simhash.RADIUS + 1
    assert len({b for p in chosen for b in p.bits}) == sum(len(p.bits) for p in chosen)


def test_a_block_that_tells_nothing_is_left_out():
    blocks = [tuple(range(i, i + 16)) for i in range(0, 64, 16)]
    shares = [np.array([1.0, 0, 0, 0])] + [np.array([2.0**-16, 16 * 2.0**-16, 120 * 2.0**-16, 560 * 2.0**-16])] * 3
    chosen = simhash.allocate(blocks, shares, 10**7)
    assert all(p.bits != blocks[0] for p in chosen)


def test_masks_meet_for_every_pair_within_the_threshold():
    part = simhash.Partition((1, 5, 9, 60), 2)
    for gone in ((1, 5), (9,), (5, 60)):
        other = sum(1 << b for b in gone)
        assert any(m & other == 0 for m in part.masks())
    assert not any(m & (1 << 1 | 1 << 5 | 1 << 9) == 0 for m in part.masks())


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=8))
def test_pair_counts_by_distance(values):
    """The transform counts what all pairs give."""
    x = np.bincount([v & 15 for v in values], minlength=16).astype(float)
    want = np.bincount([(a & 15 ^ b & 15).bit_count() for a in values for b in values], minlength=5)
    apart = np.array([sum(x[v] * x[v ^ d] for v in range(16)) for d in range(16)])
    assert np.bincount([d.bit_count() for d in range(16)], apart, 5).tolist() == want.tolist()


def test_components_of_chains_stars_and_odd_links(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(1000, 1400)] + [(5, 5), (8, 7), (7, 8), (None, 3), (3, None)]
    rows = components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    found = {r["node"]: r["component"] for r in rows}
    assert len(rows) == len(found)
    assert found == {i: 100 for i in range(100, 141)} | {i: 7 for i in (7, 8, *range(1000, 1400))}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_many_copies_are_one_class(spark):
    rows = [(i, "one text that is copied very often in this corpus", "en", "s") for i in range(500)]
    assert simhash.classes(frame(spark, rows)).where("component_id = 0").count() == 500


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    prints = [fingerprint(r["text"]) for r in docs]
    exp = [(r["doc_id"], f"{p:016x}", docs[c]["doc_id"]) for r, p, c in zip(docs, prints, class_of(prints), strict=True)]
    assert [tuple(r) for r in op1_simhash(spark, small).orderBy("doc_id").collect()] == exp
