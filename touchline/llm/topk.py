"""Exact top-k inner products by a Voronoi kNN join.

Vectors are grouped by their nearest pivot. Each data group is summed up by its size, its greatest
distance from the pivot and the few nearest of its members to the pivot; from these, every query
group gets a bound on the k-th best score that holds for all of its queries. A vector goes to a
query group only if, by its distances, it can reach that bound; the groups then solve locally.

One more component, ``sqrt(M^2 - |x|^2)`` for data (M the greatest length) and 0 for queries, turns
inner products into distances: ``|q - x|^2 = |q|^2 + M^2 - 2 q.x``. Grouping and bounds work on that,
with a margin for rounding; scores are integers throughout.

Query cells are merged into blocks of bounded size. A block meets data in chunks of bounded size,
each chunk gives its k best for each query, and the k best of those remain.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import materialise

from .tables import col

SCALE = 1024
#: Pivots are drawn from so many vectors at most; grouping is right with any pivots.
PIVOTS, PIVOT_SAMPLE = 64, 4096
BLOCK_QUERIES, CHUNK_ROWS = 2048, 16_384


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(id, q): floor(scale * component) as packed 64-bit integers; unusable vectors are left out."""

    def run(batches):
        for batch in batches:
            lists = batch["v"]
            flat = lists.flatten()
            ok = pc.fill_null(pc.is_finite(flat.cast(pa.float64())), False).to_numpy(zero_copy_only=False)
            bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            values = pc.fill_null(flat.cast(pa.float64()), 0).to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore"):
                whole = np.floor(np.where(ok, values, 0.0) * scale)
            whole = np.clip(whole, -(2.0**62), 2.0**62).astype(np.int64)
            bad = np.concatenate(([0], np.cumsum(~ok)))
            keep = np.flatnonzero(bad[bounds[1:]] == bad[bounds[:-1]])
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(pa.array(keep)), pa.array([whole[bounds[i] : bounds[i + 1]].tobytes() for i in keep], pa.binary())], ["id", "q"]
            )

    own = vectors.select(col(vec_id).cast("long").alias("id"), col(embedding).cast("array<double>").alias("v"))
    return own.where("id is not null and v is not null").mapInArrow(run, "id long, q binary")


def matrix(packed: list[bytes], width: int) -> np.ndarray:
    """Packed vectors as rows; missing components are 0."""
    out = np.zeros((len(packed), width), np.int64)
    for i, p in enumerate(packed):
        own = np.frombuffer(p, np.int64)
        out[i, : len(own)] = own
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` with all rows of ``b``; through floats where those are exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def distances(rows: np.ndarray, lift: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each row, lifted by one component, to each pivot."""
    x = np.concatenate([rows.astype(np.float64), lift[:, None]], axis=1)
    square = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def pick_pivots(sample: np.ndarray, lift: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Some of the sampled vectors, each the farthest of a few random ones from those before."""
    x = np.concatenate([sample.astype(np.float64), lift[:, None]], axis=1)
    rng, chosen = np.random.default_rng(seed), [x[0]]
    apart = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(x)):
        some = rng.integers(0, len(x), 16)
        best = some[apart[some].argmax()]
        chosen.append(x[best])
        apart = np.minimum(apart, ((x - x[best]) ** 2).sum(axis=1))
    return np.array(chosen)


def _assigned(rows: DataFrame, width: int, longest: float, pivots: np.ndarray, data: bool) -> DataFrame:
    """(id, q, cell, far): nearest pivot and the distance from it."""

    def run(batches):
        for batch in batches:
            x = matrix(batch["q"].to_pylist(), width)
            square = (x.astype(np.float64) ** 2).sum(axis=1)
            lift = np.sqrt(np.maximum(longest**2 - square, 0)) if data else np.zeros(len(x))
            d = distances(x, lift, pivots)
            cell = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            far = d[np.arange(len(cell)), cell]
            length = np.sqrt(square)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["q"], pa.array(cell.astype(np.int32)), pa.array(far), pa.array(length)], ["id", "q", "cell", "far", "length"])

    return rows.mapInArrow(run, "id long, q binary, cell int, far double, length double")


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each query: highest score, then smallest vector id."""
    order = np.lexsort((vec, -score, query))
    first = np.concatenate(([True], query[order][1:] != query[order][:-1])) if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else np.zeros(0, np.int64)
    return order[np.arange(len(order)) - start < k]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = SCALE,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products for each query, itself left out.

    ``queries`` has the columns of ``vectors``. Ties go to the smaller id; with fewer than k candidates
    all are returned. Vectors that are null, hold null or non-finite components, or have no id, take no
    part; a query id that repeats is asked once, with its least vector. Components beyond a shorter vector's end count as 0, and an empty vector scores 0. A row that
    repeats an id is a candidate of its own, but not for queries of that id. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    data = materialise(integer_vectors(vectors, vec_id, embedding, scale))
    asked = integer_vectors(queries, vec_id, embedding, scale).groupBy("id").agg(F.min("q").alias("q"))
    asked = materialise(asked)
    n_data, width_d = data.agg(F.count("*"), F.max(F.octet_length("q"))).first()
    n_asked, width_q = asked.agg(F.count("*"), F.max(F.octet_length("q"))).first()
    if not n_data or not n_asked:
        return spark.createDataFrame([], schema)
    width = max(width_d, width_q) // 8

    def longest_of(batches):
        for batch in batches:
            x = matrix(batch["q"].to_pylist(), width).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([float((x**2).sum(axis=1).max(initial=0))])], ["square"])

    longest = math.sqrt(data.mapInArrow(longest_of, "square double").agg(F.max("square")).first()[0] or 0.0)
    sample = matrix([bytes(r["q"]) for r in data.sample(min(1.0, 2 * PIVOT_SAMPLE / n_data), 11).limit(PIVOT_SAMPLE).collect()] or [b""], width)
    lift = np.sqrt(np.maximum(longest**2 - (sample.astype(np.float64) ** 2).sum(axis=1), 0))
    points = pick_pivots(sample, lift, pivots)
    near = materialise(_assigned(data, width, longest, points, True))
    ask = materialise(_assigned(asked, width, longest, points, False))

    # Summaries: of data groups the size, the radius and the k + 1 nearest members; of query groups the radius.
    sizes = {r["cell"]: r for r in near.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}
    place = F.row_number().over(Window.partitionBy("cell").orderBy("far"))
    nearest: dict[int, list[float]] = {}
    for r in near.select("cell", "far").withColumn("place", place).where(F.col("place") <= k + 1).collect():
        nearest.setdefault(r["cell"], []).append(r["far"])
    groups = {r["cell"]: r for r in ask.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}
    between = np.sqrt(np.maximum(((points[:, None] - points[None]) ** 2).sum(axis=2), 0))
    margin = 1e-6 * (longest + float(between.max(initial=0)) + 1)
    # Any query of a group has k data vectors (itself not counted) within this distance.
    reach = {}
    for c, g in groups.items():
        upper = sorted(g["radius"] + between[c, j] + d for j, ds in nearest.items() for d in ds)
        reach[c] = (upper[k] if len(upper) > k else math.inf) + margin

    # Small query cells share a block of bounded size; a large one is dealt over several blocks by a hash.
    cells_of: list[list[int]] = []
    block_of, room = {}, 0
    for c, n in sorted((c, g["n"]) for c, g in groups.items()):
        parts = math.ceil(n / BLOCK_QUERIES)
        if parts > 1 or n > room:
            block_of[c] = (len(cells_of), parts)
            cells_of += [[c] for _ in range(parts)]
            room = BLOCK_QUERIES - n if parts == 1 else 0
        else:
            block_of[c] = (len(cells_of) - 1, 1)
            cells_of[-1].append(c)
            room -= n
    first = F.create_map(*(F.lit(x) for c, (a, _) in block_of.items() for x in (c, a)))
    parts = F.create_map(*(F.lit(x) for c, (_, m) in block_of.items() for x in (c, m)))
    dealt = first[F.col("cell")] + F.pmod(F.xxhash64("id"), parts[F.col("cell")])
    blocked = ask.withColumn("block", dealt.cast("int"))
    chunks = max(1, math.ceil(n_data / CHUNK_ROWS))
    told = spark.sparkContext.broadcast((points, between, reach, {c: g["radius"] for c, g in groups.items()}, cells_of))

    def replicate(batches):
        points, between, reach, radius, cells_of = told.value
        for batch in batches:
            cell, far = batch["cell"].to_numpy(), batch["far"].to_numpy()
            chunk = (batch["id"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(chunks)
            for b, cells in enumerate(cells_of):
                need = np.zeros(len(cell), bool)
                for c in cells:
                    # Nearest that a query of cell c can be: over the query's pivot, by the triangle inequality.
                    least = np.maximum(between[c, cell] - far, 0) - radius[c]
                    need |= least <= reach[c]
                at = pa.array(np.flatnonzero(need))
                if len(at):
                    m = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, b, np.int32)), pa.array(chunk.astype(np.int32)).take(at), batch["id"].take(at), batch["q"].take(at)],
                        ["block", "chunk", "id", "q"],
                    )

    sent = near.select("id", "q", "cell", "far").mapInArrow(replicate, "block int, chunk int, id long, q binary")
    spread = blocked.select("block", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "id", "q")

    def solve(key, left, right):
        q, x = matrix(left["q"].to_pylist(), width), matrix(right["q"].to_pylist(), width)
        qid, xid = left["id"].to_numpy(), right["id"].to_numpy()
        out = []
        step = max(1, (1 << 22) // max(1, len(x)))
        for lo in range(0, len(q), step):
            s = scores(q[lo : lo + step], x)
            own = qid[lo : lo + step, None] == xid[None]
            if s.shape[1] > k + 1:
                # The k + 1 best scores, ties at the border included, and one place for the query's own row.
                s = np.where(own, np.iinfo(np.int64).min, s)
                border = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
                a, b = np.nonzero((s >= border[:, None]) & ~own)
            else:
                a, b = np.nonzero(~own)
            best = _best(qid[lo + a], xid[b], s[a, b], k)
            out.append((qid[lo + a][best], xid[b][best], s[a, b][best]))
        parts = [np.concatenate(p) if out else np.zeros(0, np.int64) for p in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, parts), strict=True)))

    local = sent.groupBy("block", "chunk").cogroup(spread.groupBy("block", "chunk")).applyInArrow(
        lambda key, right, left: solve(key, left, right), "query_id long, vec_id long, score long"
    )
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
