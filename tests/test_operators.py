import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import betting, evaluate, features, names, players, prep, profile, quantiles, resolve, split

# ---- exact order statistics


def test_quantiles_equal_numpy_with_a_hot_value(spark):
    rng = random.Random(1)
    rows = [("g", 7.0) if i % 3 == 0 else ("g", rng.gauss(0, 50)) for i in range(2000)]
    rows += [("h", float(i)) for i in range(5)] + [("g", None), ("h", float("nan"))]
    df = spark.createDataFrame(rows, "k string, x double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["k"], r["share"]): r["value"] for r in quantiles.exact_quantiles(df, ["x"], shares, by=["k"]).collect()}
    for k in "gh":
        values = [x for key, x in rows if key == k and x is not None and x == x]
        for s in shares:
            assert got[(k, s)] == pytest.approx(np.quantile(values, s))


def test_ranks_of_a_million_different_values(spark):
    n = 1_000_000
    # Spread over magnitudes and both signs, in an order of its own.
    value = F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0) * F.pow(F.lit(1.0000003), F.col("id"))
    df = spark.range(0, n, 1, 5).select(value.alias("x"), (F.col("id") * 7919 % n - n // 2).alias("k"))
    ranks = [0, 1, 12_345, n // 2 - 1, n // 2, n - 1]
    found = quantiles.value_at_ranks(df, ["x", "k"], lambda *_: ranks)
    values = np.sort(df.select("x").toPandas()["x"].to_numpy())
    assert found[(), "x"] == {r: values[r] for r in ranks}
    assert found[(), "k"] == {r: r - n // 2 for r in ranks}


def test_ordered_numbers_keep_order_and_value():
    values = np.array([-np.inf, -1e300, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1.0, np.nextafter(1.0, 2), 1e300, np.inf])
    numbers = quantiles.ordered(values)
    assert (np.diff(numbers.astype(object)) >= 0).all() and numbers[4] == numbers[5]
    assert [quantiles.restored(int(x), False) for x in numbers] == values.tolist()
    whole = np.array([-(2**63), -1, 0, 1, 2**63 - 1])
    assert [quantiles.restored(int(x), True) for x in quantiles.ordered(whole)] == whole.tolist()


def test_a_task_hands_over_bounded_counters():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    batches = [pa.RecordBatch.from_pydict({"x": rng.normal(size=50_000)}) for _ in range(4)]
    out = list(quantiles._tally(0, 1, {(): 0}, {(0, 0): [0]}, 64 - quantiles.DIGIT, quantiles.DIGIT)(batches))
    assert sum(b.num_rows for b in out) <= 1 << quantiles.DIGIT and sum(sum(b["n"].to_pylist()) for b in out) == 200_000


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("g", None), (None, 2.0), (None, 2.0), (None, 5.0)], "k string, x double")
    got = quantiles.exact_quantiles(df, ["x"], [0.5], by=["k"]).collect()
    assert [tuple(r) for r in got] == [(None, "x", 0.5, 2.0)]
    assert quantiles.exact_quantiles(df.limit(0), ["x"], [0.5]).count() == 0


def test_describe(spark):
    rng = random.Random(2)
    values = [rng.uniform(-5, 5) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = profile.describe_numeric(df, ["x"]).first()
    assert row["count"] == 501 and row["std"] == pytest.approx(np.std(values, ddof=1))
    assert [row[c] for c in ("q25", "q50", "q75")] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_profile_small(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 4.0, "x"), (3, None, "x")], "a int, b double, c string")
    assert [(r["column"], r["n_missing"]) for r in profile.null_profile(df).collect()] == [("b", 1), ("c", 1), ("a", 0)]
    corr = {(r["column_a"], r["column_b"]): r["corr"] for r in profile.corr_matrix(df, ["a", "b"]).collect()}
    assert corr[("a", "b")] == pytest.approx(1.0) and corr[("b", "a")] == pytest.approx(1.0) and len(corr) == 4
    assert profile.overview(df).first()["n_columns"] == 3
    assert [r["c"] for r in profile.value_counts(df, "c").collect()] == ["x"]
    assert profile.top_rows(df, [F.desc("a")], 1).first()["a"] == 3
    assert profile.totals(df, ["a"]).first()["a"] == 6


def test_many_pairs_are_split_over_passes(spark, monkeypatch):
    monkeypatch.setattr(profile, "PAIRS_PER_PASS", 2)
    df = spark.createDataFrame([(float(i), float(i * i), float(-i)) for i in range(9)], "a double, b double, c double")
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got[("c", "a")] == pytest.approx(-1.0)


# ---- splits


@pytest.mark.parametrize("hot", [False, True])
def test_fraction_split_equals_global_order(spark, hot):
    rng = random.Random(3)
    rows = []
    for i in range(997):
        # With `hot`, one day holds most rows, so that both cuts fall inside it.
        day = dt.date(2020, 1, 1 + (5 if hot and i % 10 else rng.randrange(28)))
        rows.append((i, None if i % 40 == 0 else day))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "match_no long, match_date date")
    got = {r["match_no"]: r["split"] for r in split.split_by_fraction(df).collect()}
    order = sorted(rows, key=lambda r: (r[1] or dt.date.max, r[0]))
    n, part = len(rows), int(len(rows) * 0.125)
    want = {m: "train" if i < n - 2 * part else "val" if i < n - part else "test" for i, (m, _) in enumerate(order)}
    assert got == want


def test_fraction_split_numbers_days_not_rows(spark):
    df = spark.range(10).select(F.col("id").alias("match_no"), F.lit(dt.date(2020, 1, 1)).alias("match_date"))
    plan = split.split_by_fraction(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    # The only window without a real key runs over the day counts, after their aggregation.
    assert "row_number" not in plan


def test_date_split_and_slices(spark):
    days = [dt.date(2019, 6, 30), dt.date(2019, 7, 1), dt.date(2022, 6, 30), dt.date(2022, 7, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "match_date date")
    assert [r["split"] for r in split.split_by_date(df).collect()] == ["train", "val", "val", "test", None]
    seasons = spark.createDataFrame([(s,) for s in ("2004", "2005", "2016", "2017", "2020", "2025", "x", None)], "season_end string")
    assert [r["slice"] for r in split.season_slices(seasons).collect()] == ["train", "train", "valid", "test", "test"]
    assert [r["season_end"] for r in split.season_rejects(seasons).collect()] == ["x"]


# ---- features and preparation

MATCH = {"Division": "E0", "MatchDate": "2020-01-01", "HomeTeam": "A", "AwayTeam": "B"}


def one(spark, **cells):
    row = {**MATCH, **cells}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))


def test_families_follow_the_columns(spark):
    plain = features.build_features(one(spark))
    assert plain.columns == "Division MatchDate MatchTime HomeTeam AwayTeam match_date cfmd_match_id y_outcome y_home_win".split()
    row = features.build_features(one(spark, OddHome="2", OddDraw="0", OddAway="4")).first()
    assert (row["qh"], row["qd"], row["qsum"], row["p_home"]) == (0.5, None, None, None)
    with_result = features.build_features(one(spark, FTResult="H")).first()
    assert (with_result["y_outcome"], with_result["y_home_win"], with_result["FTHome"]) == ("H", 1, None)
    with pytest.raises(ValueError, match="HomeTeam"):
        features.build_features(one(spark).drop("HomeTeam"))


def test_unplayed_matches(spark):
    df = one(spark, FTHome=None, FTAway="1")
    assert features.build_features(df).first()["y_outcome"] == "D"
    row = features.build_features(df, unplayed="null").first()
    assert row["y_outcome"] is None and row["y_home_win"] is None


def test_keep_columns(spark):
    kept, missing = features.keep_columns(one(spark, Extra="x"))
    assert "Extra" not in kept.columns and "FTHome" in missing
    with pytest.raises(ValueError):
        features.keep_columns(one(spark), ["nothing"])


def test_fill_derived_keeps_what_is_given(spark):
    df = spark.createDataFrame(
        [(1500.0, 1000.0, 7.0, 0.0, 2.0, 4.0, 4.0, 0.0, None, None, 0.0, None)],
        "HomeElo double, AwayElo double, elo_diff double, elo_ratio double, OddHome double, OddDraw double, OddAway double, "
        "qh double, qd double, qa double, qsum double, p_home double",
    )
    row = features.fill_derived(df).first()
    assert row["elo_diff"] == 7.0 and row["elo_ratio"] == 0.6 and row["qsum"] == 1.0
    assert row["p_home"] is None  # p_draw and p_away are not there
    assert features.fill_derived(df, "form").first()["elo_ratio"] == 1.5


def test_leakage_rules():
    columns = "y_outcome y_home_win FTHome HTResult HomeShots AwayRed HomeElo shot_acc_home shots_diff home_rest_days match_date".split()
    assert "HomeElo" not in prep.leakage_columns(columns, "baseline")
    tuned = prep.leakage_columns(columns, "tuned")
    assert set(columns) - set(tuned) == {"HomeElo", "home_rest_days", "match_date"}
    assert "shot_acc_home" not in prep.leakage_columns(columns, "tuned", keep_shot_accuracy=True)


def test_aligned_numbers_are_not_read_from_text(spark):
    df = spark.createDataFrame([(1.5, 3, "2.5", float("nan"))], "HomeElo double, Form3Home bigint, AwayElo string, OddHome double")
    out = prep.align_coerce(df.select("HomeElo", "Form3Home", "OddHome"), prep.FIXTURE_SCHEMA)
    assert "as string" not in out._jdf.queryExecution().optimizedPlan().toString()
    row = prep.align_coerce(df, prep.FIXTURE_SCHEMA).first()
    assert (row["HomeElo"], row["Form3Home"], row["AwayElo"]) == (1.5, 3.0, 2.5) and row["OddHome"] != row["OddHome"]



def test_alignment(spark):
    df = spark.createDataFrame([("20250901", "1500", "x")], "match_date string, HomeElo string, OddHome string")
    zero = prep.align_zero(df, prep.FIXTURE_SCHEMA).first()
    assert list(zero.asDict()) == prep.FIXTURE_COLUMNS and zero["AwayElo"] == 0.0
    row = prep.align_coerce(df, prep.FIXTURE_SCHEMA).first()
    assert (row["match_date"], row["HomeElo"], row["OddHome"], row["AwayElo"]) == (dt.date(2025, 9, 1), 1500.0, None, None)
    assert prep.FeatureSchema.from_json(prep.FIXTURE_SCHEMA.to_json()) == prep.FIXTURE_SCHEMA
    with pytest.raises(ValueError):
        prep.FeatureSchema.from_json("{}")


def test_medians_of_train_and_own(spark):
    rows = [("train", 1.0), ("train", 3.0), ("train", None), ("val", 10.0), ("val", None)]
    df = spark.createDataFrame(rows, "split string, x double")
    train = sorted(r["x"] for r in prep.median_impute(df, ["x"]).collect())
    own = sorted(r["x"] for r in prep.median_impute(df, ["x"], "own").collect())
    assert train == [1.0, 2.0, 2.0, 3.0, 10.0] and own == [1.0, 2.0, 3.0, 10.0, 10.0]


def test_class_weights(spark):
    df = spark.createDataFrame([("H",), ("H",), ("A",), ("D",)], "y_outcome string")
    got = {r["y_outcome"]: r["weight"] for r in prep.class_weights(df).distinct().collect()}
    assert got == pytest.approx({"H": 4 / 6, "A": 4 / 3, "D": 4 / 3})


# ---- names and matches


def test_manual_pairs_win_and_later_rows_win(spark):
    auto = spark.createDataFrame([(1, "Betis", "Betis"), (2, "Ajax", "Ajax")], "n int, fbref_team string, cfdm_team string")
    manual = spark.createDataFrame(
        [(1, "Betis", "Real Betis"), (2, "Köln", "Koeln"), (3, "Köln", "FC Koln"), (4, None, "x")],
        "n int, fbref_team string, cfdm_team string",
    )
    got = dict(r for r in names.compile_map_ordered(auto, manual, "n").collect())
    assert got == {"Betis": "Real Betis", "Ajax": "Ajax", "Köln": "FC Koln"}
    spaced = manual.select("fbref_team", F.col("cfdm_team").alias(" cfdm_team "))
    assert dict(names.compile_map(auto, spaced).collect())["Betis"] == "Real Betis"


def test_golden_pairs(spark):
    """Pairs known from the two name sources: equal after normalising, or only by hand."""
    auto = [("Alavés", "Alaves"), ("Ajaccio", "Ajaccio"), ("Málaga", "Malaga")]
    hand = [("1860 Munich", "Munich 1860"), ("Alemannia Aachen", "Aachen")]
    left = spark.createDataFrame([(a,) for a, _ in auto + hand] + [(None,)], "team_name string")
    right = spark.createDataFrame([(b,) for _, b in auto + hand], "team_name string")
    assert {(r[0], r[1]) for r in names.name_auto_map(left, right).collect()} == set(auto)
    review = names.name_review(left, right).collect()
    assert {r["fbref_team"] for r in review} == {a for a, _ in hand}
    assert {r["candidate_count"] for r in review} == {5}


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("share", [0.15, 0.4])
def test_candidates_equal_all_pairs(spark, share):
    rng = random.Random(4)
    right = ["".join(rng.choice("bdegh ") for _ in range(rng.randrange(1, 14))).strip() for _ in range(150)] + ["bbbb", "bbbbbbbb"]
    left = right[:5] + ["x" + r[1:] for r in right[5:60]] + [r[:3] + "q" + r[3:] for r in right[60:80]] + ["bbbbb", "zz", ""]
    frames = [spark.createDataFrame([(x,) for x in xs], "team_name string") for xs in (left, right)]
    found = sorted(tuple(r) for r in names.name_candidates(*frames, n=3, share=share).collect())
    norm = lambda s: " ".join(s.split())
    known, wanted = {norm(r) for r in right}, []
    for a in set(left):
        if norm(a) and norm(a) not in known:
            pairs = sorted((_edits(norm(a), norm(r)), r) for r in set(right) if norm(r))
            near = [p for p in pairs if p[0] <= int(len(norm(a)) * share)][:3]
            wanted += [(a, norm(a), i, r, d) for i, (d, r) in enumerate(near, 1)]
    assert found == sorted(wanted)


def test_candidates_in_sections_and_blocks(spark, monkeypatch):
    """Names that share all but a few letters: prefixes out of reach are left, and no row stands for a pair of names."""
    right = [f"Supplier{i:04d}" for i in range(0, 3000, 7)] + ["Süpplier0001", "s"]
    left = [f"United Supplier{i:04d}" for i in range(0, 3000, 211)] + ["Sup lier0014", "ss", "Supplier0014"]
    frames = [spark.createDataFrame([(x,) for x in xs], "team_name string") for xs in (left, right)]
    once = sorted(tuple(r) for r in names.name_candidates(*frames).collect())
    monkeypatch.setattr(names, "SECTION_NAMES", 100)
    monkeypatch.setattr(names, "BLOCK_NAMES", 4)
    cut = names.name_candidates(*frames)
    assert sorted(tuple(r) for r in cut.collect()) == once
    norm = lambda s: s.lower().replace("ü", "u")
    for a in left[:-1]:
        near = sorted((_edits(norm(a), norm(r)), r) for r in right)
        near = [p for p in near if p[0] <= int(len(a) * 0.4)][:5]
        assert [(r, d) for x, _, _, r, d in once if x == a] == [(r, d) for d, r in near]
    levels, _, _ = names._prefixes(sorted(map(norm, right)))
    grown = names._edits_within("united supplier0014", 8, levels)
    assert sum(int((t <= 8).sum()) for t in grown) < sum(len(letters) for letters, _ in levels) / 2


def test_names_without_a_key_pair_with_none(spark):
    both = spark.createDataFrame([("FC",), ("AC",), ("Ajax FC",)], "team_name string")
    assert [r[0] for r in names.name_auto_map(both, both).collect()] == ["Ajax FC"]
    assert {r["fbref_team"] for r in names.name_review(both, both.where("team_name = 'Ajax FC'")).collect()} == {"FC", "AC"}


def test_candidates_map_and_review(spark):
    day = dt.date(2020, 5, 2)
    feed = spark.createDataFrame(
        [("u1", "A", "B", day), ("u1", "A", "B", day), ("u2", "FC C", "D", day), ("u3", "E", "F", day), ("u4", "A", "B", None)],
        "match_url string, home_team_fb string, away_team_fb string, match_date_fb date",
    )
    name_map = spark.createDataFrame([("FC C", " c ")], "fbref_team string, cfdm_team string")
    rows = [("E0", "2020-05-03", "a", "B"), ("E0", "2020-05-02", "C", "D"), ("D1", "2020-05-01", "C", "D"), ("E0", "2020-05-05", "E", "F")]
    matches = spark.createDataFrame([(*r, None, 1) for r in rows], "Division string, MatchDate string, HomeTeam string, AwayTeam string, FTHome int, FTAway int")
    found = resolve.match_candidates(resolve.map_names(feed, name_map), resolve.with_match_id(matches))
    assert found.count() == 4  # u1 twice, u2 twice
    only = resolve.match_map(found).collect()
    assert [(r["match_url"], r["cfmd_match_id"], r["priority_flag"], r["days_diff"], r["FTHome"]) for r in only] == [
        ("u1", "E0|2020-05-03|a|B", 2, 1, "")
    ]
    review = resolve.match_review(found).first()
    assert review["cfmd_candidates"] == ["E0|2020-05-02|C|D", "D1|2020-05-01|C|D"]
    counts = resolve.resolution_counts(feed, found).first().asDict()
    assert counts == {"reports": 4, "none": 2, "resolved": 1, "several": 1}


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert [tuple(r) for r in players.duplicate_keys(df, ["k"], 5).collect()] == [(1, 2)]
    assert {r["v"] for r in players.duplicate_rows(df, ["k"]).collect()} == {"a", "b"}


# ---- evaluation and betting


def scored(spark):
    rows = [("H", 0.1, 0.2, 0.7), ("D", 0.4, 0.4, 0.2), ("A", 0.2, 0.3, 0.5), ("H", None, 0.5, 0.5), (None, 0.3, 0.3, 0.4)]
    return spark.createDataFrame(rows, "y_outcome string, p_A double, p_D double, p_H double").withColumn("split", F.lit("val"))


def test_scores_and_confusion(spark):
    row = evaluate.scores(scored(spark)).first()
    assert row["n_rows"] == 3 and row["accuracy"] == pytest.approx(1 / 3)
    assert row["log_loss"] == pytest.approx(-(np.log(0.7) + np.log(0.4) + np.log(0.2)) / 3)
    cm = {r["label"]: (r["pred_A"], r["pred_D"], r["pred_H"]) for r in evaluate.confusion(scored(spark)).collect()}
    assert cm == {"true_A": (0, 0, 1), "true_D": (1, 0, 0), "true_H": (0, 0, 1)}
    report = {r["label"]: r for r in evaluate.class_report(scored(spark)).collect()}
    assert report["H"]["precision"] == 0.5 and report["H"]["recall"] == 1.0 and report["D"]["f1"] == 0.0
    assert report["weighted avg"]["support"] == 3


def test_impossible_outcome_has_a_finite_loss(spark):
    df = spark.createDataFrame([("H", 1.0, 0.0, 0.0)], "y_outcome string, p_A double, p_D double, p_H double")
    assert evaluate.log_loss(df).first()["log_loss"] == pytest.approx(-np.log(1e-15))


def test_row_mode_falls_back_and_needs_all_three(spark):
    df = spark.createDataFrame(
        [(0.5, 0.3, 0.2, None, None, None), (0.5, None, 0.2, 0.5, 0.25, 0.25), (None, None, None, 0.5, None, 0.2), (None, None, None, 0.0, 0.0, 0.0)],
        "p_home double, p_draw double, p_away double, qh double, qd double, qa double",
    )
    got = [(r["o_H"], r["o_D"], r["o_A"]) for r in evaluate.odds_probabilities(df).collect()]
    assert got == [(0.5, 0.3, 0.2), (0.5, 0.25, 0.25), (None, None, None), (None, None, None)]


def test_column_mode_clips_and_normalises(spark):
    df = spark.createDataFrame([(0.6, -0.1, 0.2), (0.0, 0.0, 0.0)], "qh double, qd double, qa double")
    rows = evaluate.odds_probabilities(df, "column").collect()
    assert (rows[0]["o_H"], rows[0]["o_D"], rows[0]["o_A"]) == (pytest.approx(0.75), 0.0, pytest.approx(0.25))
    assert rows[1]["o_H"] is None


def test_blend_prefers_the_better_source(spark):
    rows = [("H", 0.1, 0.1, 0.8, 0.4, 0.4, 0.2)] * 4
    df = spark.createDataFrame(rows, "y_outcome string, p_A double, p_D double, p_H double, o_A double, o_D double, o_H double")
    assert evaluate.blend_search(df).first()["alpha"] == 1.0
    assert evaluate.blend_losses(df).count() == 21
    assert evaluate.blended(df, 0.5).first()["p_H"] == pytest.approx(0.5)


def test_edges(spark):
    df = spark.createDataFrame(
        [(0.2, 0.2, 0.6, 4.0, 4.0, 2.0), (0.2, 0.2, 0.6, None, 4.0, 2.0)],
        "p_A double, p_D double, p_H double, odd_A double, odd_D double, odd_H double",
    )
    full, gap = betting.edges_normalised(df, kelly=True).collect()
    assert (full["best_pick"], full["best_edge"], full["kelly_frac"]) == ("H", pytest.approx(0.1), pytest.approx(0.2))
    assert full["bet_recommendation"] == "H"
    assert (gap["best_pick"], gap["best_edge"], gap["kelly_frac"], gap["bet_recommendation"]) == ("A", None, 0.0, "")
    assert betting.edges_normalised(df.drop("odd_A")).columns == [c for c in df.columns if c != "odd_A"]


def test_raw_edges_thresholds(spark):
    df = spark.createDataFrame(
        [(0.25, 0.25, 0.5, 4.0, 0.0, 2.0)], "p_A double, p_D double, p_H double, OddAway double, OddDraw double, OddHome double"
    )
    row = betting.edges_raw(df, kelly=True).first()
    assert (row["edge_home"], row["kelly_home"]) == (0.0, 0.0)  # at the threshold, not above it
    assert (row["edge_draw"], row["kelly_draw"]) == (0.25, 0.0)  # no usable price
    assert betting.edges_raw(df.drop("OddHome")).first()["edge_home"] == 0.5


def test_review_makes_candidates_once(spark):
    """``review_rows`` counts over the rows that were dealt; ``resolution_counts`` shuffles only what it needs."""
    day = dt.date(2020, 1, 1)
    rows = [("u1", day, "A", "B", "m1", day, "A", "B", "E0", "1", "0", 0, 1), ("u1", day, "A", "B", "m1", day, "A", "B", "E0", "1", "0", 1, 2),
            ("u1", day, "A", "B", "m2", day, "A", "B", "E1", "1", "0", 1, 2), ("u2", day, "C", "D", "m3", day, "C", "D", "E0", "1", "0", 0, 1),
            (None, day, "C", "D", "m3", day, "C", "D", "E0", "1", "0", 0, 1), (None, day, "C", "D", "m4", day, "C", "D", "E0", "1", "0", 0, 1)]
    schema = ("match_url string, match_date_fb date, home_team_cf string, away_team_cf string, cfmd_match_id string, match_date_cf date, "
              "HomeTeam string, AwayTeam string, Division string, FTHome string, FTAway string, days_diff int, priority_flag int")  # fmt: skip
    candidates = spark.createDataFrame(rows, schema)
    review = resolve.review_rows(candidates)
    assert review.columns == [*candidates.columns, "candidate_count"]
    told = {(r["match_url"], r["cfmd_match_id"], r["candidate_count"], r["days_diff"]) for r in review.collect()}
    assert told == {("u1", "m1", 2, 0), ("u1", "m2", 2, 1)} and review.count() == 2
    assert " Join " not in review._jdf.queryExecution().optimizedPlan().toString()
    feed = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "match_url string")
    counts = resolve.resolution_counts(feed, candidates)
    assert tuple(counts.first()) == (3, 1, 1, 1)
    dealt = [x for x in counts._jdf.queryExecution().optimizedPlan().toString().split("\n") if "RepartitionByExpression" in x]
    assert dealt and "HomeTeam" not in counts._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[0]
