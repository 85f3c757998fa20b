"""Token pieces against the tokenizer, packing against its bounds."""

import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from touchline.llm import packing
from touchline.llm.queries import op4_packing, tokenizer_path

from .conftest import ODD

WHOLE = Tokenizer.from_file(tokenizer_path())


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert packing.token_ids(pa.array([text]), tokenizer_path())[0].tolist() == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbéÉßÿÀ×÷'stredvml019.,!_-<|>\n \t\x1c\xa0́ΣİI", max_size=40))
def test_ids_of_mixed_texts(text):
    assert packing.token_ids(pa.array([text]), tokenizer_path())[0].tolist() == ids_of(text)


def test_remembered_chunks_are_bounded():
    few = packing.ChunkIds(tokenizer_path(), remembered=3)
    for w in "a few different words and the same words again".split() * 2:
        assert list(few.chunk(w)) == ids_of(w)
    assert len(few.known) <= 3


def check(rows, docs, capacity=2048):
    """Pieces are those of the tokenizer, sequences are gapless and no longer than the capacity."""
    exp = []
    for d, t in docs:
        ids = np.array([*ids_of(t), 0], dtype="<u4")
        exp += [(d, k, k * capacity, len(c), zlib.crc32(c.tobytes())) for k in range(-(-len(ids) // capacity)) for c in [ids[k * capacity : (k + 1) * capacity]]]
    order = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted((tuple(r)[:5] for r in rows), key=order) == sorted(exp, key=order)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_odd_rows(odd):
    rows = packing.pack_documents(odd, tokenizer_path()).collect()
    n = check(rows, [r[:2] for r in ODD])
    lengths = defaultdict(int)
    for r in rows:
        lengths[r["length"]] += 1
    assert n == packing.lower_bound(lengths)


def test_ids_come_on_request(odd):
    rows = packing.token_pieces(odd.where("doc_id = 1"), tokenizer_path(), with_ids=True).collect()
    assert list(rows[0]["ids"]) == [*ids_of(ODD[0][1]), 0]


def test_empty_table(none):
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_bound_is_below_the_best_packing(lengths):
    bins, offsets, fill = packing.best_fit_decreasing(lengths, 12)
    assert fill.max() <= 12 and fill.sum() == sum(lengths) and len(fill) == bins.max() + 1

    def fits(m):  # exhaustive
        def place(rest, room):
            if not rest:
                return True
            return any(place(rest[1:], room[:i] + (r - rest[0],) + room[i + 1 :]) for i, r in enumerate(room) if r >= rest[0])

        return place(sorted(lengths, reverse=True), (12,) * m)

    best = next(m for m in range(1, len(lengths) + 1) if fits(m))
    assert packing.lower_bound({n: lengths.count(n) for n in lengths}, 12) <= best <= len(fill)


def test_bound_sees_what_the_sum_misses():
    assert packing.lower_bound({7: 5}, 12) == 5
    assert packing.lower_bound({5: 6, 4: 1}, 12) == 4 and packing.lower_bound({}, 12) == 0
    assert all(packing.lower_bound({a: 1, b: 1}, 12) == 1 + (a + b > 12) for a, b in combinations_with_replacement(range(1, 13), 2) if a != b)


def test_groups_exchange_what_does_not_fill(spark):
    """Many groups of few pieces: exchanging unfilled bins brings the count near the bound."""
    rng = np.random.default_rng(5)
    rows = [(int(i), int(n)) for i, n in enumerate(rng.integers(1, 2048, 3000))]
    pieces = spark.createDataFrame(rows, "uid long, length long")
    alone = packing.pack_pieces(pieces, group_rows=150, rounds=1).select("sequence_id").distinct().count()
    done = packing.pack_pieces(pieces, group_rows=150).collect()
    bound = packing.lower_bound({n: sum(1 for _, m in rows if m == n) for n in {m for _, m in rows}})
    assert {r["uid"] for r in done} == set(range(3000)) and len(done) == 3000
    used = len({r["sequence_id"] for r in done})
    assert bound <= used < alone and used <= 1.02 * bound


def test_query(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = op4_packing(spark, small).collect()
    n = check(rows, docs)
    assert n <= 1.02 * (sum(r["length"] for r in rows) / 2048) + 1
