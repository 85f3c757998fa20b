"""History over a stream against the batch job on the same rows, restart included."""

import pytest
from pyspark.sql import functions as F

from touchline.operators import history
from touchline.streaming.history import history_stream

from test_history import SCHEMA, hot_matches

NAMES = [f"{s}_{c}" for s in ("home", "away") for c in history.LAGGED]


def told(df):
    rows = df.select("match_id", "HomeTeam", "FTHome", *NAMES).collect()
    return {r["match_id"]: tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in rows}


def test_stream_equals_batch_after_a_restart(spark, tmp_path):
    rows = [(i, d, *rest) for i, d, *rest in hot_matches(240)]
    matches = spark.createDataFrame(rows, SCHEMA)
    # Files come in the order of time; undated matches last.
    cuts = ["2020-02-01", "2020-03-15", "2020-05-01", "2020-07-30", None]
    wanted = told(history.lagged_features(matches))
    low = ""
    for n, high in enumerate(cuts):
        part = matches.where(F.col("MatchDate").isNull()) if high is None else matches.where((F.col("MatchDate") > low) & (F.col("MatchDate") <= high))
        part.coalesce(1).write.json(str(tmp_path / "in" / str(n)))
        low = high or low
        # Each run is a restart from the checkpoint of the one before.
        stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in" / "*"))
        history_stream(stream, str(tmp_path / "out"), str(tmp_path / "marks")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == len(rows) and told(out) == wanted
    assert out.where("late").count() == 0


def test_a_late_row_is_told(spark, tmp_path):
    row = lambda i, day: (i, day, "12:00", "E0", "A", f"B{i}", i, 0, 1.0, 1.0)
    for n, rows in enumerate([[row(2, "2020-01-02"), row(3, "2020-01-03")], [row(1, "2020-01-01"), row(4, "2020-01-04")]]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(str(tmp_path / "in" / str(n)))
        stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in" / "*"))
        history_stream(stream, str(tmp_path / "out"), str(tmp_path / "marks")).awaitTermination()
    out = {r["match_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {i: r["late"] for i, r in out.items()} == {1: True, 2: False, 3: False, 4: False}
    assert out[4]["home_gf_last3"] == 1 + 2 + 3 and out[1]["home_gf_last3"] is None


@pytest.mark.parametrize("n", range(9))
def test_figures_of_short_histories(n):
    from touchline.streaming.history import figures

    past = [(i, "", "", i, "home", i, 1, 3, float(i * i), i) for i in range(n)]
    out = dict(zip(history.LAGGED, figures(past, (99, "", "", 99, "home", 0, 0, 0, 0.0, n + 4)), strict=True))
    assert out["gf_last3"] == (sum(range(n)[-3:]) if n else None) and out["rest_days"] == (5 if n else None)
    steps = [(i + 1) ** 2 - i**2 for i in range(n - 1)][-min(n, 6) + 1 :] if n > 1 else []
    assert out["elo_trend5"] == (pytest.approx(sum(steps[-5:]) / len(steps[-5:])) if steps else None)
    assert out["form_momentum"] == ({1: 6, 2: 3}.get(n - 3, 0) if n > 3 else None)


def test_a_teams_rows_are_told_as_each_alone():
    """All rows of a team at once give what each gives with its own past; gaps included."""
    import numpy as np
    from touchline.streaming.history import figures, histories

    rng = np.random.default_rng(7)
    gap = lambda v: None if rng.random() < 0.25 else v
    rows = [(i, "", "", i, "home", gap(int(rng.integers(5))), gap(int(rng.integers(5))), int(rng.choice([0, 1, 3])), gap(1500.0 + i * i), gap(3 * i)) for i in range(40)]
    told = histories(*([r[f] for r in rows] for f in range(5, 10)))
    for i, row in enumerate(rows):
        alone = figures(rows[:i], row)
        assert [None if np.isnan(c[i]) else c[i] for c in told] == [None if x is None else pytest.approx(x) for x in alone]
        assert all(x is None or type(x) is (float if c.startswith("elo") else int) for c, x in zip(history.LAGGED, alone, strict=True))
    assert [len(c) for c in histories([], [], [], [], [])] == [0] * len(history.LAGGED)
