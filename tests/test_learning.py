import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from touchline.operators import evaluate, features, learn, prep
from touchline.plans import features as feature_plan
from touchline.plans import resolution, training
from touchline.streaming import ingest, scoring
from workload import adapters

COLUMNS = ["HomeElo", "AwayElo", "elo_diff", "OddHome", "OddDraw", "OddAway", "qh", "qd", "qa", "p_home", "p_draw", "p_away"]


def league(n=600, seed=9):
    """Matches whose outcome follows the rating gap, in three dated parts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        h, a = rng.uniform(1000, 2000), rng.uniform(1000, 2000)
        gap = (h - a) / 400 + rng.gauss(0, 0.4)
        goals = (2, 0) if gap > 0.3 else (0, 2) if gap < -0.3 else (1, 1)
        day = dt.date(2018, 1, 1) + dt.timedelta(days=int(i * 2100 / n))
        ph = 1 / (1 + 10 ** (-(h - a) / 400))
        odds = [None] * 3 if i % 25 == 0 else [0.95 / (0.75 * ph + 0.01), 3.8, 0.95 / (0.75 * (1 - ph) + 0.01)]
        rows.append((f"{i}", "E0", day.isoformat(), f"T{i % 17}", f"U{i % 13}", *map(str, goals), str(h), str(a), *[o and str(o) for o in odds]))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    names = "id Division MatchDate HomeTeam AwayTeam FTHome FTAway HomeElo AwayElo OddHome OddDraw OddAway".split()
    raw = spark.createDataFrame(league(), ", ".join(f"{n} string" for n in names))
    base = features.build_features(raw, carry=("id",))
    cut = training.split_rows(base)
    return cut.cache()


@pytest.fixture(scope="module")
def boosted(rows):
    params = learn.BoostedParams(rounds=4, depth=2, min_leaf=5)
    return training.train_boosted(rows, exclude=("id",), params=params, calibration="isotonic")


def losses(frame):
    return {r["split"]: r["log_loss"] for r in frame.collect()}


def sums_to_one(df):
    for r in df.select("p_A", "p_D", "p_H").collect():
        assert sum(r) == pytest.approx(1.0) and min(r) >= 0


def test_boosted_beats_guessing_and_is_calibrated(boosted):
    assert all(v < 1.05 for v in losses(boosted.scores).values())
    sums_to_one(boosted.scored)
    assert {r["split"] for r in boosted.benchmark.collect()} == {"val", "test"}
    blend = training.blend_with_market(boosted).first()
    assert 0.0 <= blend["alpha"] <= 1.0 and blend["n_rows"] > 0
    assert set(training.report(boosted.scored)) == {"scores", "classes", "confusion", "reliability"}


def test_sigmoid_and_storage(spark, rows, boosted, tmp_path):
    val = prep.median_impute(prep.missing_flags(rows.select("id", "split", prep.LABEL, *COLUMNS)), COLUMNS).where("split = 'val'")
    missing = [c for c in boosted.columns if c not in val.columns]
    assert not [c for c in missing if c in COLUMNS]
    ready = val.selectExpr("*", *[f"0.0D as {c}" for c in missing])
    for model in (learn.calibrate(boosted.model, ready, "sigmoid"), boosted.calibrated):
        path = str(tmp_path / model.method)
        schema = prep.FeatureSchema(tuple(boosted.columns), (), tuple(boosted.columns))
        learn.save(model, schema, spark, path)
        loaded, same = learn.load(spark, path)
        assert same == schema
        before = {r["id"]: r["p_H"] for r in model.score(ready).collect()}
        after = {r["id"]: r["p_H"] for r in loaded.score(ready).collect()}
        assert before == pytest.approx(after)
    with pytest.raises(ValueError):
        learn.calibrate(boosted.model, ready, "other")


def test_baselines(rows):
    result = training.train_baselines(rows, exclude=("id",), trees=5, depth=4, max_iter=30)
    got = {(r["model"], r["split"]): r["log_loss"] for r in result.scores.collect()}
    assert set(got) == {(m, s) for m in ("logistic", "forest") for s in ("val", "test")}
    assert all(v < 1.05 for v in got.values())


def test_empty_cells_are_filled_as_in_training(spark, rows, boosted, tmp_path):
    """A fixture with empty cells scores as the same row imputed by hand, also after a reload."""
    inputs = [c for c in boosted.columns if not c.endswith("__is_na")]
    schema = prep.FeatureSchema(tuple(inputs), ("match_date",), ("match_date", *inputs))
    learn.save(boosted.calibrated, schema, spark, str(tmp_path / "m"))
    loaded, schema = learn.load(spark, str(tmp_path / "m"))
    medians = learn.medians_of(loaded)
    assert medians == learn.medians_of(boosted.calibrated) and set(COLUMNS) <= set(medians)
    table = rows.where("split = 'test'").select("id", "match_date", *inputs).limit(30)
    given = [c for c in inputs if c != "qa"]  # one column is absent
    holes = table.selectExpr("id", "match_date", *[f"case when {i} % 3 = 0 then null else {c} end as {c}" for i, c in enumerate(given)])
    value = {c: f"{medians.get(c, 0.0)}D" for c in inputs}
    whole = holes.selectExpr("id", "match_date", *[f"coalesce({c}, {value[c]}) as {c}" for c in given], f"{value['qa']} as qa")
    score = lambda df, how: {r["id"]: r["proba_home"] for r in training.score_fixtures(df, loaded, schema, missing=how).collect()}
    assert score(holes, "median") == pytest.approx(score(whole, "keep"))
    picks = training.score_fixtures(table, loaded, schema, kelly=True, threshold=0.05, edges="normalised")
    for r in picks.collect():
        assert (r["bet_recommendation"] != "") == (r["best_edge"] is not None and r["best_edge"] >= 0.05)
    with pytest.raises(ValueError):
        training.score_fixtures(table, loaded, schema, missing="other")


def test_search_is_repeatable(rows):
    ready = prep.fill_zero(rows, COLUMNS).cache()
    train, val = ready.where("split = 'train'"), ready.where("split = 'val'")
    space = learn.SEARCH_SPACE | {"rounds": (1, 3), "depth": (2, 3)}
    first = learn.search(train, val, COLUMNS, trials=2, seed=3, space=space)
    assert first == learn.search(train, val, COLUMNS, trials=2, seed=3, space=space)


def test_halving_finds_the_winner_of_all(rows):
    ready = prep.fill_zero(rows, COLUMNS).cache()
    train, val = ready.where("split = 'train'"), ready.where("split = 'val'")
    # One draw in four learns fast; the others hardly move.
    space = learn.SEARCH_SPACE | {"rounds": (4, 8), "depth": (2, 4), "step": (0.005, 0.4)}
    whole = learn.search_trials(train, val, COLUMNS, trials=4, seed=5, space=space, halvings=0)
    halved = learn.search_trials(train, val, COLUMNS, trials=4, seed=5, space=space, halvings=1)
    assert len(whole) == 4 and len(halved) == 2 and [t.loss for t in whole] == sorted(t.loss for t in whole)
    assert halved[0] == whole[0] and halved[0].rounds == halved[0].params.rounds


def test_rows_of_a_search_are_made_ready_once(rows, monkeypatch):
    """One preparation for all trials, and the losses of models that are fitted one by one."""
    ready = prep.fill_zero(rows, COLUMNS).cache()
    train, val = ready.where("split = 'train'"), ready.where("split = 'val'")
    calls, plain = [], learn.preprocess
    monkeypatch.setattr(learn, "preprocess", lambda *made: calls.append(made) or plain(*made))
    space = learn.SEARCH_SPACE | {"rounds": (2, 3), "depth": (2, 3)}
    done = learn.search_trials(train, val, COLUMNS, trials=2, seed=3, space=space, halvings=1)
    assert len(calls) == 1
    alone = learn.fit_boosted(train, COLUMNS, done[0].params)
    assert done[0].loss == pytest.approx(learn.evaluate.log_loss(alone.score(val)).first()["log_loss"], abs=1e-9)


def test_prefix_losses_are_those_of_shorter_models(rows):
    ready = prep.fill_zero(rows, COLUMNS).cache()
    train, val = ready.where("split = 'train'"), ready.where("split = 'val'")
    fit = lambda n: learn.fit_boosted(train, COLUMNS, learn.BoostedParams(rounds=n, depth=2))
    long, short = learn.prefix_losses(fit(3), val), learn.prefix_losses(fit(2), val)
    n = min(len(long), len(short))  # either may have stopped early
    assert n and len(long) <= 3 and long[:n] == pytest.approx(short[:n])


def test_draws_cover_the_whole_space():
    rng = random.Random(42)
    drawn = [learn.draw(rng, learn.BoostedParams(rounds=100, depth=4)) for _ in range(300)]
    assert {p.depth for p in drawn} == set(range(3, 11))
    assert min(p.rounds for p in drawn) < 60 and max(p.rounds for p in drawn) > 190
    assert all(0.02 <= p.step <= 0.15 and 18 <= p.min_leaf <= 80 and 0.5 <= p.sample <= 1 for p in drawn)


def test_unknown_category_gets_a_slot(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string")
    model = Pipeline(stages=learn.preprocess(["x"], ["c"])).fit(train)
    out = model.transform(spark.createDataFrame([(1.0, "new")], "x double, c string")).first()
    assert len(out["features"]) >= 3


def test_categories_through_training_storing_and_serving(spark, rows, tmp_path):
    text = rows.withColumn("league", F.concat(F.lit("L"), (F.col("id").cast("int") % 3).cast("string")))
    params = learn.BoostedParams(rounds=5, depth=2)
    result = training.train_boosted(text, exclude=("id",), params=params, categorical=("league",))
    assert result.model.categories == {"league": ["L0", "L1", "L2"]}
    schema = prep.FeatureSchema(tuple(COLUMNS), ("league",), ("league", *COLUMNS))
    learn.save(result.calibrated, schema, spark, str(tmp_path / "model"))
    loaded, again = learn.load(spark, str(tmp_path / "model"))
    assert learn.categories_of(loaded) == {"league": ["L0", "L1", "L2"]} and again == schema
    table = text.where("split = 'test'").select("id", "league", *COLUMNS).limit(20)
    score = lambda df: {r["id"]: r["proba_home"] for r in training.score_fixtures(df, loaded, again).collect()}
    assert score(table) == {r["id"]: pytest.approx(r["proba_home"]) for r in training.score_fixtures(table, result.calibrated, schema).collect()}
    unseen, missing, absent = table.withColumn("league", F.lit("new")), table.withColumn("league", F.lit(None).cast("string")), table.drop("league")
    assert score(unseen) == score(missing) == score(absent)


def test_a_dictionary_keeps_the_most_frequent(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 5).cast("string"))).otherwise(F.concat(F.lit("rare"), F.col("id").cast("string"))).alias("c"))
    assert learn.category_dictionary(df, ["c"], most=4, tracked=4096)["c"][0] == "hot"
    assert learn.category_dictionary(df.withColumn("c", F.lit(None).cast("string")), ["c"]) == {"c": []}
    assert learn.category_dictionary(df, []) == {}


def test_stream_scores_like_the_table(spark, rows, boosted, tmp_path):
    schema = prep.FeatureSchema(tuple(COLUMNS), ("match_date",), ("match_date", *COLUMNS))
    table = rows.select("id", "match_date", *COLUMNS)
    folder, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    table.write.parquet(folder)
    stream = spark.readStream.schema(table.schema).parquet(folder)
    scoring.score_stream(stream, boosted.calibrated, schema, sink, marks, kelly=True).awaitTermination()
    batch = training.score_fixtures(table, boosted.calibrated, schema, kelly=True)
    columns = "id proba_home proba_draw proba_away edge_home kelly_home".split()
    want = sorted(map(tuple, batch.select(*columns).collect()))
    assert sorted(map(tuple, spark.read.parquet(sink).select(*columns).collect())) == want
    # Nothing new: a second run adds nothing.
    scoring.score_stream(stream, boosted.calibrated, schema, sink, marks, kelly=True).awaitTermination()
    assert spark.read.parquet(sink).count() == len(want)


def test_stream_ingest_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    sink, done, marks = (str(tmp_path / n) for n in ("sink", "done", "marks"))
    schema = "league string, season int, v int"
    struct = spark.createDataFrame([], schema).schema

    def run():
        stream = ingest.read_stream(spark, str(source), struct)
        ingest.ingest(stream, sink, done, marks, ["league", "season"]).awaitTermination()
        return sorted(r["v"] for r in spark.read.parquet(sink).collect())

    (source / "a.csv").write_text("league,season,v\nL,1,1\nL,1,2\n")
    assert run() == [1, 2]
    assert run() == [1, 2]
    (source / "b.csv").write_text("league,season,v\nL,1,7\nL,2,3\n")
    assert run() == [1, 2, 3, 7]
    assert run() == [1, 2, 3, 7]


def test_feature_plan(spark, tiny):
    m = adapters.matches_text(spark, tiny)
    out = feature_plan.match_features(m, divisions=("EUROPE", "ASIA"), match_id="match_no")
    assert out.count() == m.where("Division in ('EUROPE', 'ASIA')").count()
    assert {"home_form_momentum", "p_home", "y_outcome"} <= set(out.columns)


def test_resolution_plan(spark):
    title = "Leeds vs. FC Hull Match Report – Saturday May 2, 2020"
    tail = f'/m/1,L,S,summary,leeds,"{title}",L,2020'
    lines = spark.createDataFrame([(",".join(["P"] + ["1"] * 30) + "," + tail,)], "value string")
    matches = spark.createDataFrame(
        [("E0", "2020-05-02", "Leeds", "Hull", "1", "0")],
        "Division string, MatchDate string, HomeTeam string, AwayTeam string, FTHome string, FTAway string",
    )
    manual = spark.createDataFrame([], "fbref_team string, cfdm_team string")
    out = resolution.resolve_matches(lines, matches, manual)
    assert out.match_map.first()["cfmd_match_id"] == "E0|2020-05-02|Leeds|Hull"
    assert out.counts.first()["resolved"] == 1


def test_reliability_bins(spark):
    rows = [("val", "H" if i % 2 else "A", 0.5 - i / 400, 0.25, 0.25 + i / 400) for i in range(100)]
    df = spark.createDataFrame(rows, "split string, y_outcome string, p_A double, p_D double, p_H double")
    bins = evaluate.reliability(df).orderBy("bin").collect()
    assert len(bins) == 10 and sum(b["n_rows"] for b in bins) == 100


def test_the_counts_of_a_pass_fit_beside_the_other_tasks():
    """Four tasks of an executor of 10 GB hold them outside the managed 60 %, and once more for their shuffle."""
    assert 2 * 4 * learn.NODE_MEMORY <= 0.4 * 10_240


def test_report_scores_rows_once(spark):
    """Rows of a report come from a model, so however many figures are taken of them, they are scored once."""
    scored = spark.sparkContext.accumulator(0)

    def model(batches):
        for batch in batches:
            scored.add(batch.num_rows)
            yield batch

    rows = spark.range(60, numPartitions=2).selectExpr(
        "'test' as split", "element_at(array('H', 'D', 'A'), cast(id % 3 as int) + 1) as y_outcome",
        "0.2 + id / 200.0D as p_H", "0.3D as p_D", "0.5 - id / 200.0D as p_A", "id as match_no",
    )
    rows = rows.mapInArrow(model, rows.schema)
    told = {name: figures.collect() for name, figures in training.report(rows).items()}
    assert scored.value == 60
    assert sum(r["n_rows"] for r in told["scores"]) == 60 and len(told["confusion"]) == 3
