"""Top-k against all scores."""

import math

import numpy as np
import pytest

from touchline.llm import topk
from touchline.llm.queries import op2_topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q int, cell int"


def expected(rows, asked, k):
    own = [(i, [math.floor(float(np.float32(c)) * 1024) for c in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, v in sorted({i: v for i, v in reversed(own) if i in asked}.items()):
        scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in own if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def found(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], SCHEMA)


def test_odd_vectors(spark):
    rows = [(0, [1.0, -0.5]), (1, [1.0, -0.5]), (2, None), (3, [1.0, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 1.0])]
    rows += [(6, [0.3]), (7, []), (None, [1.0, 1.0]), (8, [0.25, 0.25, 4.0]), (9, [-1e-9, 0.0]), (10, [1.0, -0.5])]
    frame = vectors(spark, rows)
    assert found(topk.top_k(frame, frame.where("vec_id % 2 = 0"), k=4)) == expected(rows, {0, 6, 8, 10}, 4)
    assert found(topk.top_k(frame, frame.where("vec_id % 2 = 0"), k=50)) == expected(rows, {0, 6, 8, 10}, 50)


def test_empty_tables(spark):
    frame = vectors(spark, [(0, [1.0])])
    assert topk.top_k(frame.limit(0), frame).count() == 0 == topk.top_k(frame, frame.where("vec_id < 0")).count()
    assert topk.top_k(frame, frame).count() == 0  # no candidate but itself


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_clusters_hot_groups_ties_and_small_blocks(spark, monkeypatch, spread):
    """A third of all rows are one vector; blocks and chunks are so small that all are cut."""
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 200)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8)) * 3
    rows = [(i, (centres[i % 12] + spread * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(800)]
    rows += [(i, rows[0][1]) for i in range(800, 1200)]
    frame = vectors(spark, rows)
    assert found(topk.top_k(frame, frame.where("vec_id % 10 = 0"), k=5, pivots=16)) == expected(rows, set(range(0, 1200, 10)), 5)


def test_tight_clusters_need_no_all_pairs_join(spark):
    rng = np.random.default_rng(1)
    centres = np.eye(16) * 4
    rows = [(i, (centres[i % 16] + 0.01 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(1600)]
    frame = vectors(spark, rows)
    got = topk.top_k(frame, frame.where("vec_id = 3"), k=5, pivots=64)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert found(got) == expected(rows, {3}, 5)


def test_large_components_stay_integers():
    a, b = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, -5]])
    assert topk.scores(a, b).tolist() == [[(2**40 + 1) * (2**20 + 1) - 15]]


def test_query(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert found(op2_topk(spark, small)) == expected(rows, {i for i, _ in rows if i % 100 == 0}, 10)
