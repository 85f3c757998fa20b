"""Rolling form and streaks against plain loops, with and without cut timelines."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from touchline import session
from touchline.operators import history, streaks, timeline
from workload import adapters

SCHEMA = (
    "match_id long, MatchDate string, MatchTime string, Division string, HomeTeam string, AwayTeam string, "
    "FTHome int, FTAway int, HomeElo double, AwayElo double"
)


def hot_matches(n=400, seed=5):
    """One team plays in a third of the matches and more; some rows lack date, time or score."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        others = rng.sample([f"T{k}" for k in range(30)], 2)
        home, away = ("HOT", others[0]) if i % 3 == 0 else (others[1], "HOT") if i % 7 == 0 else tuple(others)
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(200))
        rows.append(
            (
                i,
                None if i % 50 == 0 else day.isoformat(),
                None if i % 11 == 0 else f"{rng.randrange(24)}:{rng.randrange(60):02d}",
                rng.choice(["E0", "D1", None]),
                home,
                away,
                None if i % 40 == 0 else rng.randrange(5),
                rng.randrange(5),
                None if i % 30 == 0 else float(rng.randrange(1000, 2000)),
                float(rng.randrange(1000, 2000)),
            )
        )
    return rows


def loops(rows):
    """The same figures by walking each team's matches in order."""
    sides = []
    for m, day, time, division, home, away, fh, fa, eh, ea in rows:
        seconds = 0 if time is None else int(time.split(":")[0]) * 3600 + int(time.split(":")[1]) * 60
        date = dt.date.fromisoformat(day) if day else None
        for side, team, opp, gf, ga, elo in (("home", home, away, fh, fa, eh), ("away", away, home, fa, fh, ea)):
            won = gf is not None and ga is not None and gf > ga
            drew = gf is not None and ga is not None and gf == ga
            lost = gf is not None and ga is not None and gf < ga
            key = (date or dt.date.max, seconds, division is None, division or "", opp, m, side)
            sides.append((team, key, m, side, date, gf, ga, elo, 3 if won else 1 if drew else 0, won, lost))
    out = {}
    for team in {s[0] for s in sides}:
        past = []
        run = {"win": 0, "losing": 0, "nowin": 0, "noloss": 0}
        for _, _, m, side, date, gf, ga, elo, pts, won, lost in sorted(
            (s for s in sides if s[0] == team), key=lambda s: s[1]
        ):
            prev = past[-1] if past else None
            change = elo - prev["elo"] if prev and elo is not None and prev["elo"] is not None else None

            def add(field, first, last):
                seen = [p[field] for p in past[len(past) - first if len(past) > first else 0 : len(past) - last + 1]]
                seen = [x for x in seen if x is not None]
                return sum(seen) if seen else None

            def mean(first):
                seen = [p["change"] for p in past[-first:] if p["change"] is not None]
                return sum(seen) / len(seen) if seen else None

            before = past[-6:-3] if len(past) >= 4 else []
            out[(m, side)] = {
                "rest_days": (date - prev["date"]).days if prev and date and prev["date"] else None,
                "elo_change": change,
                "gf_last3": add("gf", 3, 1),
                "ga_last5": add("ga", 5, 1),
                "pts_last3": add("pts", 3, 1),
                "elo_trend3": mean(3),
                "elo_trend5": mean(5),
                "form_momentum": add("pts", 3, 1) - sum(p["pts"] for p in before) if before else None,
                **{f"{k}_streak_in": v for k, v in run.items()},
            }
            past.append({"gf": gf, "ga": ga, "pts": pts, "elo": elo, "date": date, "change": change})
            run["win"] = run["win"] + 1 if won else 0
            run["losing"] = run["losing"] + 1 if lost else 0
            run["nowin"] = 0 if won else run["nowin"] + 1
            run["noloss"] = 0 if lost else run["noloss"] + 1
    return out


def agree(frame, expected):
    names = [c for c in next(iter(expected.values())) if c in frame.columns]
    assert names
    rows = frame.collect()
    assert len(rows) == len(expected)
    for row in rows:
        want = expected[(row["match_id"], row["side"])]
        for c in names:
            assert row[c] == (pytest.approx(want[c]) if want[c] is not None else None), (row, c, want)


@pytest.mark.parametrize("span_days", [1, 30, 366])
def test_rolling_equals_loop(spark, span_days):
    rows = hot_matches()
    view = history.team_view(spark.createDataFrame(rows, SCHEMA))
    agree(history.rolling(view, span_days), loops(rows))


@pytest.mark.parametrize("span_days", [1, 30, 366])
def test_streaks_equal_loop(spark, span_days):
    rows = hot_matches()
    view = history.team_view(spark.createDataFrame(rows, SCHEMA))
    agree(streaks.streaks(view, span_days=span_days), loops(rows))


def test_streaks_as_written_do_not_depend_on_cuts(spark):
    view = history.team_view(spark.createDataFrame(hot_matches(), SCHEMA))
    plain = streaks.streaks(view, "as_written").collect()
    cut = streaks.streaks(view, "as_written", span_days=9).collect()
    assert sorted(map(str, plain)) == sorted(map(str, cut))


def test_a_hot_team_is_many_spans(spark):
    view = history.team_view(spark.createDataFrame(hot_matches(), SCHEMA))
    spans = timeline.spanned(view, 20).where("team = 'HOT'").groupBy(*timeline.SPAN).count().collect()
    total = sum(r["count"] for r in spans)
    assert total > 150 and max(r["count"] for r in spans) < total / 5
    # Undated rows, too.
    assert sum(r["span"] >= timeline.LAST_SLOT for r in spans) > 1


def test_last_rows_of_earlier_spans(spark):
    rows = [(i, f"2020-0{1 + i // 4}-0{1 + i % 4}", "12:00", "E0", "A", f"B{i}", i, 0, float(i), 1.0) for i in range(12)]
    view = history.team_view(spark.createDataFrame(rows, SCHEMA)).where("team = 'A'")
    found = timeline.last_rows(timeline.spanned(view, 31), history.ORDER, ["goals_for"], 6).collect()
    before = {r["span"]: [x["goals_for"] for x in r["before"]] for r in found}
    assert [before[k] for k in sorted(before)] == [[], [3, 2, 1, 0], [7, 6, 5, 4, 3, 2]]


def test_attach_modes(spark):
    rows = [
        (1, "2020-01-01", "12:00", "E0", "A", "B", 1, 0, 1.0, 1.0),
        (2, "2020-01-08", "12:00", "E0", "A", "C", 2, 0, 2.0, 1.0),
        (3, "2020-01-08", "12:00", "E0", "A", "D", 3, 0, 4.0, 1.0),
        (4, None, None, "E0", "A", "B", 1, 1, 5.0, 1.0),
    ]
    m = spark.createDataFrame(rows, SCHEMA)
    by_id = history.lagged_features(m)
    assert by_id.count() == 4
    assert by_id.where("match_id = 4").first()["home_gf_last3"] == 6
    three = history.lagged_features(m, attach="three_key")
    assert three.count() == 6
    assert three.where("match_id = 4").first()["home_gf_last3"] is None
    with pytest.raises(ValueError):
        history.lagged_features(m, attach="other")


def test_first_match_has_no_history_and_short_history_is_partial(spark):
    rows = [(i, f"2020-01-0{i}", "12:00", "E0", "A", f"B{i}", i, 0, 1.0, 1.0) for i in range(1, 6)]
    view = history.team_view(spark.createDataFrame(rows, SCHEMA))
    a = {r["match_id"]: r for r in history.rolling(view).where("team = 'A'").collect()}
    assert a[1]["gf_last3"] is None and a[2]["gf_last3"] == 1 and a[5]["gf_last3"] == 2 + 3 + 4
    assert a[4]["form_momentum"] is None and a[5]["form_momentum"] == 9 - 3


def test_rows_are_shuffled_once(spark):
    rows = history.team_view(spark.createDataFrame(hot_matches(50), SCHEMA))
    plan = history.rolling(rows)._jdf.queryExecution().executedPlan().toString()
    main, summary = plan.split("WindowGroupLimit", 1)
    # One exchange of the rows with all columns; the other one carries what each task kept of a span.
    assert main.count("Exchange hashpartitioning(team_key") - main.count("Exchange hashpartitioning(team_key#0") <= 3
    assert "WindowGroupLimit" in summary and "CartesianProduct" not in plan and "goals_for" in summary


def test_latest_matches(spark):
    found = streaks.streaks(history.team_view(spark.createDataFrame(hot_matches(), SCHEMA)))
    rows = streaks.latest_matches(found, 5, team="HOT").collect()
    assert len(rows) == 5
    days = [r["match_date"] for r in rows if r["match_date"]]
    assert days == sorted(days, reverse=True)
    each = streaks.latest_matches(found, 5)
    assert {r["n"] for r in each.groupBy("team").agg(F.count("*").alias("n")).collect()} == {5}
    assert {r["match_id"] for r in each.where("team = 'HOT'").collect()} == {r["match_id"] for r in rows}
    assert "WindowGroupLimit" in each._jdf.queryExecution().sparkPlan().toString()


def test_typed_numbers_are_not_read_from_text(spark):
    """Numbers of the wanted type go as they are; text is cast."""
    cells = "1 match_id, '2020-01-01' MatchDate, 'E0' Division, 'A' HomeTeam, 'B' AwayTeam"
    typed = spark.sql(f"select {cells}, 2 FTHome, 1 FTAway, cast('NaN' as double) HomeElo, 1500.5D AwayElo")
    text = spark.sql(f"select {cells}, '2.0' FTHome, ' 1' FTAway, 'NaN' HomeElo, '1500.5' AwayElo")
    rows = [str(history.base_rows(x, "match_id").drop("match_date").collect()) for x in (typed, text)]
    assert rows[0] == rows[1]
    plans = [history.base_rows(x, "match_id")._jdf.queryExecution().analyzed().toString() for x in (typed, text)]
    assert ["cast(FTHome#" in p for p in plans] == ["cast(AwayElo#" in p for p in plans] == [False, True]


def test_team_rows_of_the_queries_are_cast_once(spark, tiny):
    from workload.queries import view

    plan = view(spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "RLIKE" not in plan and "Generate" not in plan


def test_slices_give_the_same_history(spark, tiny):
    """Steps that each shuffle a part of the teams and of the matches give the rows of one step, and leave one table."""
    matches = adapters.matches(spark, tiny).where("match_no % 7 = 0").withColumn("HomeTeam", F.when(F.col("match_no") % 5 != 0, F.col("HomeTeam")))
    matches = matches.withColumn("_slice", history.slice_of(F.col("match_no"), 3))
    before = len(session._written)
    got = history.sliced_lagged_features(session.write_table(matches, ["_slice"]), 3, "match_no")
    want = history.lagged_features(matches.drop("_slice"), "match_no")
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and len(session._written) == before + 2
