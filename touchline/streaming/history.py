"""Matches and fixtures that arrive as a stream, each with the history of both teams.

A team's last six matches are its keyed state. Rows of a team that come in one batch are put in order
with them; each row gets the figures that a batch job gives it, as long as a team's rows arrive in the order of
time. A row older than the state knows is told ``late``: its history ends at what is still held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from touchline.operators.history import DEPTH, LAGGED, ORDER, team_view
from touchline.operators.learn import BoostedModel, CalibratedModel
from touchline.operators.prep import FeatureSchema
from touchline.operators.timeline import LAST_NAME
from touchline.plans.training import score_fixtures

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# What a team's state keeps of a match: its place in the order, then the figures.
PLACE = "slot long, division_key string, opponent_key string, match_id long, side string"
HELD = f"{PLACE}, goals_for int, goals_against int, points int, elo double, day int"
FIGURES = "gf_last3 long, ga_last3 long, pts_last3 long, elo_trend3 double, gf_last5 long, ga_last5 long, pts_last5 long, elo_trend5 double, rest_days int, form_momentum long"
_NAMES = [c.split()[0] for c in HELD.split(", ")]
_KINDS = [{"string": str, "double": float}.get(c.split()[1], int) for c in HELD.split(", ")]
_GF, _GA, _POINTS, _ELO, _DAY = range(len(ORDER), len(_NAMES))


def histories(goals_for: list, goals_against: list, points: list, elo: list, day: list) -> list[np.ndarray]:
    """``LAGGED`` of each of a team's matches, which come in order; not a number where there is nothing to tell."""
    goals_for, goals_against, points, elo, day = (np.array(x, np.float64) for x in (goals_for, goals_against, points, elo, day))

    def back(values: np.ndarray, k: int) -> np.ndarray:
        return np.concatenate((np.full(min(k, len(values)), np.nan), values[: max(0, len(values) - k)]))

    def added(there: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
        # Oldest first, as a row's own sum would be.
        total = np.zeros(len(day))
        for has, value in zip(there, values, strict=True):
            total[has] += value[has]
        return total

    def total(values: np.ndarray, first: int, upto: int) -> np.ndarray:
        before = [back(values, k) for k in range(upto, first - 1, -1)]
        there = [~np.isnan(x) for x in before]
        return np.where(np.any(there, axis=0), added(there, before), np.nan)

    def trend(upto: int) -> np.ndarray:
        steps = [(back(elo, k), back(elo, k + 1)) for k in range(upto, 0, -1)]
        there = [~np.isnan(new) & ~np.isnan(old) for new, old in steps]
        n = np.sum(there, axis=0)
        with np.errstate(invalid="ignore"):
            return np.where(n > 0, added(there, [new - old for new, old in steps]) / np.maximum(n, 1), np.nan)

    three, five = ([total(x, 1, upto) for x in (goals_for, goals_against, points)] for upto in (3, 5))
    return [*three, trend(3), *five, trend(5), day - back(day, 1), three[2] - total(points, 4, DEPTH)]


def figures(past: list[tuple], now: tuple) -> tuple:
    """``LAGGED`` of a match, from the team's matches before it, oldest first (the last six count)."""
    rows = [*past[-DEPTH:], now]
    told = histories(*([m[f] for m in rows] for f in (_GF, _GA, _POINTS, _ELO, _DAY)))
    kinds = (float if c.startswith("elo") else int for c in LAGGED)
    return tuple(None if np.isnan(x[-1]) else kind(x[-1]) for x, kind in zip(told, kinds, strict=True))


def _plain(values: list, kind: type) -> list:
    """Values as they are kept; pandas gives whole numbers with gaps as floats, and gaps as what is no number."""
    if kind is str:
        return [v if isinstance(v, str) else None for v in values]
    return [None if v is None or v != v else kind(v) for v in values]


class TeamHistory(StatefulProcessor):
    """The last six matches of a team, and the history of each row that arrives for it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getListState("last", HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = [tuple(x) for x in self.last.get()]
        columns = [list(c) for c in zip(*known, strict=True)] or [[] for _ in _NAMES]
        arrived = []
        for frame in rows:
            for c, kind, values in zip(_NAMES, _KINDS, columns, strict=True):
                values += _plain(frame[c].tolist(), kind)
            arrived += _plain(frame["match"].tolist(), str)
        places = list(zip(*columns[: len(ORDER)], strict=True))
        order = sorted(range(len(places)), key=places.__getitem__)
        first: dict[tuple, int] = {}
        for at, i in enumerate(order):
            first.setdefault(places[i], at)
        payload = dict(zip(places[len(known) :], arrived, strict=True))
        newest = places[len(known) - 1] if known else None
        told = histories(*([columns[f][i] for i in order] for f in (_GF, _GA, _POINTS, _ELO, _DAY)))
        at = np.array([first[p] for p in payload], np.int64)
        self.last.put([tuple(c[i] for c in columns) for i in order[-DEPTH:]])
        yield pd.DataFrame(
            {
                "match_id": [p[3] for p in payload],
                "side": [p[4] for p in payload],
                **{c: values[at] for c, values in zip(LAGGED, told, strict=True)},
                "late": [newest is not None and p < newest for p in payload],
                "match": list(payload.values()),
            }
        )

    def close(self) -> None:
        pass


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Keyed state with several values needs this store; a provider the user has set stays."""
    name = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(name, "").rpartition(".")[2] in ("", "HDFSBackedStateStoreProvider"):
        spark.conf.set(name, STORE)


def sides_with_history(matches: DataFrame, match_id: str = "match_id") -> DataFrame:
    """A stream of matches -> a row for each side with its history; the home side carries the match as JSON."""
    whole = matches.withColumn("match", F.to_json(F.struct(*matches.columns)))
    view = team_view(whole, match_id, carry=("match",))
    view = view.select(
        F.coalesce("team", F.lit(LAST_NAME)).alias("team_key"),
        *ORDER[:-2],
        F.col("match_id").cast("long").alias("match_id"),
        "side",
        *(F.col(c).cast("int").alias(c) for c in ("goals_for", "goals_against", "points")),
        "elo",
        F.unix_date("match_date").alias("day"),
        F.when(F.col("side") == "home", F.col("match")).alias("match"),
    )
    schema = f"match_id long, side string, {FIGURES}, late boolean, match string"
    return view.groupBy("team_key").transformWithStateInPandas(TeamHistory(), schema, "Append", "None")


def matches_with_history(sides: DataFrame, schema) -> DataFrame:
    """Both sides of each match on one row: the match's columns, ``home_`` and ``away_`` history, and ``late``."""
    own = [F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{s}_{c}") for s in ("home", "away") for c in LAGGED]
    rows = sides.groupBy("match_id").agg(F.max("match").alias("match"), F.bool_or("late").alias("late"), *own)
    rows = rows.withColumn("match", F.from_json("match", schema))
    return rows.select("match.*", *(f"{s}_{c}" for s in ("home", "away") for c in LAGGED), "late")


def history_stream(
    matches: DataFrame,
    sink: str,
    checkpoint: str,
    match_id: str = "match_id",
    model: BoostedModel | CalibratedModel | None = None,
    features: FeatureSchema | None = None,
    **scoring,
) -> StreamingQuery:
    """Take in what has arrived and stop: matches with their history, as Parquet, scored if there is a ``model``.

    ``match_id`` names a whole-number column without repeats. Each batch writes a folder of its own, which
    a repeated batch overwrites, so neither a restart nor a failure half-way writes a match twice; the state
    is restored from the checkpoint. ``scoring`` goes to ``score_fixtures``, which fills with medians only what
    history cannot give.
    """
    keep_state_in_rocksdb(matches.sparkSession)
    schema = matches.schema

    def write(batch: DataFrame, number: int) -> None:
        rows = matches_with_history(batch, schema)
        if model is not None:
            rows = score_fixtures(rows, model, features, **scoring)
        rows.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return (
        sides_with_history(matches, match_id)
        .writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
