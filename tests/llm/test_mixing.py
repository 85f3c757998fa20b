"""Mixing: targets against a plain sharing loop, copies against their rates, odd rows, native plan."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from touchline.llm import mixing
from touchline.llm.queries import op11_mixing

from .conftest import ODD, frame


def shared(sizes, weights, share, most):
    """Targets by sharing again what sources could not take."""
    out, left, open_ = dict.fromkeys(sizes, Fraction(0)), Fraction(share) * sum(sizes.values()), {s for s in sizes}
    while left > 0 and open_:
        total = sum(weights[s] for s in open_)
        for s in open_:
            out[s] += left * weights[s] / total
        left = sum((out[s] - most * sizes[s] for s in open_ if out[s] > most * sizes[s]), Fraction(0))
        for s in list(open_):
            if out[s] >= most * sizes[s]:
                out[s] = Fraction(most * sizes[s])
                open_.discard(s)
    return out


CASES = [
    {"a": 100, "b": 100, "c": 100},
    {"a": 1, "b": 1000, "c": 1, "d": 5, "e": 70},
    {"a": 0, "b": 0},
    {"z": 0, "y": 9, "Z": 4, "é": 3, "😀": 8, "": 2, None: 1},
    {f"s{i:02d}": (i * 7919) % 1000 for i in range(60)},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets(spark, sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r for r in mixing.targets(mixing.weighted(table)).collect()}
    wanted = shared(sizes, weights, mixing.SHARE, mixing.MOST)
    assert {s: r["weight"] for s, r in found.items()} == weights
    assert {s: r["target"] for s, r in found.items()} == pytest.approx({s: float(t) for s, t in wanted.items()})


def test_odd_rows(spark, odd, none):
    rows = mixing.planned(odd, odd.columns).collect()
    assert len(rows) == len(ODD) and [c for c in rows[0].__fields__] == [*odd.columns, "mix"]
    for r in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["mix"]["size"] == size and 0 <= r["mix"]["copies"] <= 2
    taken = Counter()
    for r in rows:
        taken[r["doc_id"], r["text"], r["source"]] += r["mix"]["copies"]
    emitted = mixing.mixed(odd)
    assert emitted.columns == odd.columns
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in emitted.collect()) == +taken
    assert mixing.planned(none, ["doc_id"]).count() == 0 and mixing.mixed(none).count() == 0


def test_equal_rows_draw_one_by_one_and_reruns_agree(spark):
    # A third of the rows is one row without an id; they must not all be taken, or all left.
    rows = [(None, "same few words here", "en", "a")] * 600 + [(i, f"doc {i} has five words", "en", "ab"[i % 2]) for i in range(1200)]
    docs = frame(spark, rows)

    def run(partitions):
        plan = mixing.planned(docs.repartition(partitions), ["doc_id", "source"]).select("doc_id", "source", "mix.*")
        return Counter(map(tuple, plan.collect()))

    one = run(3)
    assert one == run(7)
    taken, target = defaultdict(int), {}
    for (_, source, size, _, goal, copies), n in one.items():
        taken[source] += size * copies * n
        target[source] = goal
    assert all(taken[s] == pytest.approx(target[s], rel=0.05) for s in target)
    same = {copies: n for (d, _, _, _, _, copies), n in one.items() if d is None}
    assert len(same) == 2 or sum(k * n for k, n in same.items()) == 1200


def test_query_is_native_and_near_its_targets(spark, small):
    df = op11_mixing(spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumnRenamed("doc_id", "id")
    told = df.join(docs, F.col("doc_id") == F.col("id")).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert sum(r["taken"] for r in told) == pytest.approx(sum(r["target"] for r in told), rel=0.1)
