"""Placement: the filled table against plain turns, balance, small moves, native plan."""

from collections import Counter

import pytest

from touchline.llm import sharding
from touchline.llm.queries import SHARDS, op7_sharding

from .conftest import ODD


def turns(names, size):
    """The table by its definition: each name in turn takes the first free slot of its list."""
    owner = {}
    lists = {n: [(sharding._number(n, "offset") + k * (sharding._number(n, "step") % (size - 1) + 1)) % size for k in range(size)] for n in names}
    while len(owner) < size:
        for n in sorted(names):
            free = next((s for s in lists[n] if s not in owner), None)
            if free is not None and len(owner) < size:
                owner[free] = n
    return [owner[s] for s in range(size)]


@pytest.mark.parametrize("names", [["a"], ["b", "a"], [f"s{i}" for i in range(7)]])
def test_table_is_filled_in_turns(names):
    assert [names[i] for i in sharding.fill_table(names, 101)] == turns(names, 101)


def test_balance_weights_and_small_moves():
    names = [f"s{i}" for i in range(10)]
    table = sharding.fill_table(names, 65_537)
    own = Counter(table)
    assert max(own.values()) - min(own.values()) <= 1
    less = sharding.fill_table(names[:-1], 65_537)
    moved = sum(a != b for a, b in zip(table, less)) / 65_537
    assert 0.1 <= moved <= 0.2
    weighted = Counter(sharding.fill_table({"a": 1, "b": 3}, 10_007))
    assert weighted[1] / weighted[0] == pytest.approx(3, rel=0.01)


@pytest.mark.parametrize(("names", "size"), [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2), ({"a": 0}, 7)])
def test_bad_tables_are_refused(names, size):
    with pytest.raises(ValueError):
        sharding.fill_table(names, size)


def test_odd_rows(spark, odd, none):
    placed = sharding.place(odd, "text", ["x", "y", "z"], 101)
    assert placed.columns == [c for c in odd.columns if c != "slot"] + ["slot", "shard"]
    rows = placed.collect()
    assert len(rows) == len(ODD)
    owner = sharding.fill_table(["x", "y", "z"], 101)
    assert all(0 <= r["slot"] < 101 and r["shard"] == owner[r["slot"]] for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text"] or "", set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    assert sharding.place(none, "text", ["x"], 101).count() == 0


def test_query(spark, small):
    df = op7_sharding(spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan
    owner = sharding.fill_table(SHARDS)
    rows = df.collect()
    docs = {r["doc_id"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == docs and all(owner[r["slot"]] == r["shard"] for r in rows)
