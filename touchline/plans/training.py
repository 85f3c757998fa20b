"""Train, tune, calibrate, compare with the market, and score fixtures."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.chance import LABELS
from touchline.operators import betting, evaluate, learn, prep, split
from touchline.session import materialise, spread


@dataclass(frozen=True)
class Baselines:
    logistic: object
    forest: object
    scores: DataFrame
    rows: DataFrame


def _numeric_features(df: DataFrame, mode: str) -> list[str]:
    numeric, _ = prep.split_types(prep.drop_leakage(df, mode))
    return numeric


def _stack(frames: dict[str, DataFrame]) -> DataFrame:
    named = [f.select(F.lit(n).alias("model"), "split", "n_rows", "accuracy", "log_loss") for n, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


def train_baselines(
    features: DataFrame,
    exclude: tuple[str, ...] = (),
    trees: int = 300,
    depth: int = 14,
    max_iter: int = 1000,
) -> Baselines:
    """Logistic regression and random forest on zero-filled numbers; needs a ``split`` column."""
    columns = [c for c in _numeric_features(features, "baseline") if c not in exclude]
    rows = prep.fill_zero(features.where("split is not null"), columns).select("split", prep.LABEL, *columns)
    ready = materialise(rows, "zstd")
    train = ready.where("split = 'train'")
    logistic = learn.fit_logistic(train, columns, max_iter=max_iter)
    forest = learn.fit_forest(train, columns, trees, depth)
    # A row goes through hundreds of deep trees, so small tables, too, are scored by all cores.
    dealt = spread(ready, 1)
    held_out = dealt.where("split <> 'train'")
    scores = _stack(
        {n: evaluate.scores(learn.score(held_out, m), ("split",)) for n, m in (("logistic", logistic), ("forest", forest))}
    )
    return Baselines(logistic, forest, scores, dealt)


@dataclass(frozen=True)
class Boosted:
    model: learn.BoostedModel
    calibrated: learn.CalibratedModel
    columns: list[str]
    params: learn.BoostedParams
    scored: DataFrame
    scores: DataFrame
    benchmark: DataFrame
    rows: DataFrame


def train_boosted(
    features: DataFrame,
    exclude: tuple[str, ...] = (),
    params: learn.BoostedParams = learn.BoostedParams(),
    calibration: str = "sigmoid",
    medians: str = "train",
    mode: str = "boosted",
    weights: dict[str, float] | None = None,
    trials: int = 0,
    categorical: tuple[str, ...] = (),
) -> Boosted:
    """Boosted trees with missing flags and median fill, calibrated on the validation rows.

    ``categorical`` columns are taken as text, whatever the list of leaking columns says.

    ``trials`` above 0 searches the parameters first. ``scored`` holds the
    uncalibrated chances on validation and the calibrated ones on test rows.
    """
    columns = [c for c in _numeric_features(features, mode) if c not in exclude]
    odds = [c for c in (*evaluate.SHARE_COLUMNS.values(), *evaluate.RAW_COLUMNS.values()) if c in features.columns]
    market = evaluate.odds_probabilities(features.where("split is not null"), "row") if odds else features
    keep = [f"o_{c}" for c in LABELS] if odds else []
    columns = [c for c in columns if c not in categorical]
    text = [F.col(c).cast("string").alias(c) for c in categorical]
    flagged = prep.missing_flags(market.select("split", prep.LABEL, *keep, *text, *columns))
    inputs = [c for c in flagged.columns if c not in ("split", prep.LABEL, *keep, *categorical)]
    kept_medians = prep.training_medians(flagged, columns)
    own = medians == "own"
    ready = materialise(prep.median_impute(flagged, columns, "own") if own else prep.fill_values(flagged, kept_medians), "zstd")
    train, val, test = (ready.where(F.col("split") == s) for s in ("train", "val", "test"))
    if trials:
        params, _ = learn.search(train, val, inputs, trials, params.seed, base=params, categorical=categorical)
    model = learn.fit_boosted(train, inputs, params, weights, categorical=categorical)
    model.medians = kept_medians
    calibrated = learn.calibrate(model, val, calibration)
    scored = materialise(model.score(val).unionByName(calibrated.score(test)))
    scores = _stack({"boosted": evaluate.scores(scored, ("split",))})
    benchmark = evaluate.odds_benchmark(features.where("split in ('val', 'test')"), "row") if odds else scores
    return Boosted(model, calibrated, inputs, params, scored, scores, benchmark, ready)


def recalibrated(result: Boosted, calibration: str) -> Boosted:
    """The same boosted model with other maps from scores to chances."""
    val, test = (result.rows.where(F.col("split") == s) for s in ("val", "test"))
    calibrated = learn.calibrate(result.model, val, calibration)
    scored = materialise(result.model.score(val).unionByName(calibrated.score(test)))
    scores = _stack({"boosted": evaluate.scores(scored, ("split",))})
    return replace(result, calibrated=calibrated, scored=scored, scores=scores)


def blend_with_market(result: Boosted) -> DataFrame:
    """The weight chosen on validation rows and what the blend scores on test rows."""
    weight = evaluate.blend_search(result.scored.where("split = 'val'"))
    alpha = weight.select("alpha").scalar()
    test = evaluate.blended(result.scored.where("split = 'test'"), alpha)
    return evaluate.scores(test, ("split",)).withColumn("alpha", alpha)


def report(scored: DataFrame, label: str = prep.LABEL) -> dict[str, DataFrame]:
    """Scores, class report, confusion matrix and reliability curve of scored rows with a ``split``.

    What they read is written once: the reliability curve alone reads its rows up to seven times. Starts jobs.
    """
    scored = materialise(scored.select("split", label, *evaluate.PROBABILITIES))
    return {
        "scores": evaluate.scores(scored, ("split",), label),
        "classes": evaluate.class_report(scored, label),
        "confusion": evaluate.confusion(scored, label),
        "reliability": evaluate.reliability(scored, label=label),
    }


def score_fixtures(
    fixtures: DataFrame,
    model: learn.BoostedModel | learn.CalibratedModel,
    schema: prep.FeatureSchema,
    kelly: bool = False,
    threshold: float = 0.0,
    missing: str = "median",
    edges: str = "raw",
) -> DataFrame:
    """Fixtures with outcome chances, edges, and stakes.

    ``missing``  "median" fills empty cells and absent columns as training did; "zero" puts 0,
                 "keep" leaves them. Columns that training saw no value of are 0.
                 A category that training did not see, or that is absent, has the slot for all others.
    ``edges``    "raw" against 1 / price; "normalised" against the market without its margin,
                 with the best pick and whether to bet.

    Works on a stream as on a table.
    """
    if missing not in ("median", "zero", "keep") or edges not in ("raw", "normalised"):
        raise ValueError(f"unknown option: {missing}, {edges}")
    inputs = {c: f"_in_{c}" for c in fixtures.columns}
    both = fixtures.withColumns({kept: F.col(c) for c, kept in inputs.items()})
    aligned = prep.missing_flags(prep.align_coerce(both, schema, carry=tuple(inputs.values())))
    wanted, medians = learn.model_columns(model), learn.medians_of(model)
    empty = None if missing == "median" else 0.0
    aligned = aligned.withColumns({c: F.lit(empty).cast("double") for c in wanted if c not in aligned.columns})
    if missing == "median":
        aligned = prep.fill_values(aligned, {c: medians.get(c, 0.0) for c in wanted})
    if missing == "zero":
        aligned = prep.fill_zero(aligned, wanted)
    text = {c: F.col(inputs[c]) if c in inputs else F.lit(None) for c in learn.categories_of(model)}
    aligned = aligned.withColumns({c: value.cast("string") for c, value in text.items()})
    scored = model.score(aligned)
    chances = [f"p_{c}" for c in LABELS]
    back = scored.select(*[F.col(kept).alias(c) for c, kept in inputs.items()], *chances)
    if edges == "normalised":
        return betting.edges_normalised(back, betting.FIXTURE_ODDS, threshold, kelly)
    return betting.edges_raw(back, threshold=threshold, kelly=kelly)


def split_rows(features: DataFrame, **cuts) -> DataFrame:
    """Features with their ``split`` by cut-off days; undated rows are left out."""
    return split.split_by_date(features, **cuts).where("split is not null")
