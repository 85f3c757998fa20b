"""Scores of predicted outcome probabilities, and the market they compete with.

Frames carry the true label, p_A, p_D, p_H, and optionally a group such as
``split``. Missing labels or probabilities leave a row out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.casts import present, ratio
from touchline.functions.chance import LABELS, add_up, first_maximum, negative_log, pick
from touchline.operators.quantiles import exact_quantiles

PROBABILITIES = tuple(f"p_{c}" for c in LABELS)
# Odds columns of each outcome, normalised and raw.
SHARE_COLUMNS = {"H": "p_home", "D": "p_draw", "A": "p_away"}
RAW_COLUMNS = {"H": "qh", "D": "qd", "A": "qa"}
# Fixed value: blend weights 0, 0.05, .. 1.
BLEND_STEPS = 20


def predicted(labels: tuple[str, ...] = LABELS) -> Column:
    """Most likely label; the first in ``labels`` wins a tie."""
    return first_maximum([F.col(f"p_{c}") for c in labels], labels)


def true_probability(label: str = "y_outcome") -> Column:
    return pick(F.col(label), {c: F.col(f"p_{c}") for c in LABELS})


def _complete(df: DataFrame, label: str) -> DataFrame:
    ready = F.col(label).isin(*LABELS)
    for p in PROBABILITIES:
        ready = ready & present(p).isNotNull()
    return df.where(ready)


def accuracy(df: DataFrame, by: tuple[str, ...] = (), label: str = "y_outcome") -> DataFrame:
    hit = F.when(predicted() == F.col(label), 1.0).otherwise(0.0)
    return _complete(df, label).groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(hit).alias("accuracy"))


def log_loss(df: DataFrame, by: tuple[str, ...] = (), label: str = "y_outcome") -> DataFrame:
    loss = negative_log(true_probability(label))
    return _complete(df, label).groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(loss).alias("log_loss"))


def scores(df: DataFrame, by: tuple[str, ...] = (), label: str = "y_outcome") -> DataFrame:
    """Accuracy and log loss in one pass."""
    hit = F.when(predicted() == F.col(label), 1.0).otherwise(0.0)
    loss = negative_log(true_probability(label))
    return (
        _complete(df, label)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.avg(hit).alias("accuracy"), F.avg(loss).alias("log_loss"))
    )


def confusion(df: DataFrame, label: str = "y_outcome") -> DataFrame:
    """One row ``true_X`` per label with the counts ``pred_X``, all labels present."""
    cells = [
        F.count_if((F.col(label) == t) & (F.col("_pred") == p)).alias(f"{t}{p}") for t in LABELS for p in LABELS
    ]
    counts = _complete(df, label).withColumn("_pred", predicted()).agg(*cells)
    rows = [
        F.struct(F.lit(f"true_{t}").alias("label"), *[F.col(f"{t}{p}").alias(f"pred_{p}") for p in LABELS])
        for t in LABELS
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def class_report(df: DataFrame, label: str = "y_outcome") -> DataFrame:
    """precision, recall, f1 and support per label, with their macro and weighted means.

    A label never predicted has precision 0, one that never occurs has recall 0.
    """
    counts = confusion(df, label)
    wide = counts.agg(
        *[
            F.max(F.when(F.col("label") == f"true_{t}", F.col(f"pred_{p}"))).alias(f"{t}{p}")
            for t in LABELS
            for p in LABELS
        ]
    )

    def part(top: Column, base: Column) -> Column:
        return F.coalesce(ratio(top, base), F.lit(0.0))

    rows = {}
    for c in LABELS:
        hit = F.col(f"{c}{c}").cast("double")
        support = add_up([F.col(f"{c}{p}") for p in LABELS])
        precision = part(hit, add_up([F.col(f"{t}{c}") for t in LABELS]).cast("double"))
        recall = part(hit, support.cast("double"))
        rows[c] = {
            "precision": precision,
            "recall": recall,
            "f1": part(2.0 * precision * recall, precision + recall),
            "support": support,
        }
    total = add_up([r["support"] for r in rows.values()])
    measures = ("precision", "recall", "f1")
    macro = {m: add_up([r[m] for r in rows.values()]) / F.lit(float(len(LABELS))) for m in measures}
    weighted = {
        m: part(add_up([r[m] * r["support"] for r in rows.values()]), total.cast("double")) for m in measures
    }
    rows["macro avg"] = {**macro, "support": total}
    rows["weighted avg"] = {**weighted, "support": total}
    entries = [
        F.struct(F.lit(name).alias("label"), *[r[m].alias(m) for m in (*measures, "support")])
        for name, r in rows.items()
    ]
    return wide.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def reliability(df: DataFrame, target: str = "H", bins: int = 10, by: str = "split", label: str = "y_outcome") -> DataFrame:
    """Mean predicted probability and observed frequency of one label per quantile bin.

    Bin edges are exact quantiles per group; one row of edges per group (a split
    name) is broadcast. Empty bins do not appear.
    """
    p = f"p_{target}"
    rows = _complete(df, label).select(by, F.col(p).alias("p"), F.when(F.col(label) == target, 1.0).otherwise(0.0).alias("y"))
    shares = [i / bins for i in range(1, bins)]
    edges = (
        exact_quantiles(rows, ["p"], shares, by=[by])
        .groupBy(by)
        .agg(F.array_sort(F.collect_list("value")).alias("edges"))
    )
    number = F.size(F.filter("edges", lambda e: e < F.col("p")))
    return (
        rows.join(F.broadcast(edges), by)
        .groupBy(by, number.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg("p").alias("mean_predicted"),
            F.avg("y").alias("observed"),
        )
    )


def odds_probabilities(df: DataFrame, mode: str = "row") -> DataFrame:
    """Market probabilities ``o_A``, ``o_D``, ``o_H``; NULL where the odds do not cover a match.

    ``column``  the p_* columns when the table has them, else the raw q* columns
                (negative values set to 0); then divided by the sum of what is there;
    ``row``     per row: p_* when all three are present, else q* when all three
                are and add up to more than 0.
    """
    has = set(df.columns)
    if mode == "column":
        if has.issuperset(SHARE_COLUMNS.values()):
            source = {c: present(n) for c, n in SHARE_COLUMNS.items()}
        elif has.issuperset(RAW_COLUMNS.values()):
            source = {c: F.when(present(n) < 0, 0.0).otherwise(present(n)) for c, n in RAW_COLUMNS.items()}
        else:
            raise ValueError("no odds columns")
        total = add_up([F.coalesce(v, F.lit(0.0)) for v in source.values()])
        return df.withColumns({f"o_{c}": ratio(v, total) for c, v in source.items()})
    if mode != "row":
        raise ValueError(f"unknown odds mode: {mode}")
    blank = F.lit(None).cast("double")

    def complete(names: dict[str, str]) -> Column:
        ready = F.lit(has.issuperset(names.values()))
        for n in names.values():
            ready = ready & (present(n).isNotNull() if n in has else F.lit(False))
        return ready

    def cell(names: dict[str, str], c: str) -> Column:
        return present(names[c]) if names[c] in has else blank

    raw_total = add_up([cell(RAW_COLUMNS, c) for c in LABELS])
    return df.withColumns(
        {
            f"o_{c}": F.when(complete(SHARE_COLUMNS), cell(SHARE_COLUMNS, c)).when(
                complete(RAW_COLUMNS) & (raw_total > 0), ratio(cell(RAW_COLUMNS, c), raw_total)
            )
            for c in LABELS
        }
    )


def odds_benchmark(
    df: DataFrame, mode: str = "row", by: tuple[str, ...] = ("split",), label: str = "y_outcome"
) -> DataFrame:
    """Rows, rows the market covers, and its log loss and accuracy on those.

    A tie for the most likely outcome goes to the home side in ``column`` mode and
    to the first label in ``row`` mode.
    """
    order = ("H", "D", "A") if mode == "column" else LABELS
    rows = odds_probabilities(df, mode)
    known = F.lit(True)
    for c in LABELS:
        known = known & F.col(f"o_{c}").isNotNull()
    covered = known & F.col(label).isin(*LABELS)
    truth = pick(F.col(label), {c: F.col(f"o_{c}") for c in LABELS})
    guess = first_maximum([F.col(f"o_{c}") for c in order], order)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(covered).alias("covered"),
        F.avg(F.when(covered, negative_log(truth))).alias("log_loss"),
        F.avg(F.when(covered, F.when(guess == F.col(label), 1.0).otherwise(0.0))).alias("accuracy"),
    )


def blend_losses(df: DataFrame, label: str = "y_outcome") -> DataFrame:
    """Log loss of alpha * model + (1 - alpha) * market for 21 weights, in one pass.

    ``df`` holds p_* of the model and o_* of the market.
    """
    model = true_probability(label)
    market = pick(F.col(label), {c: F.col(f"o_{c}") for c in LABELS})
    ready = _complete(df, label).where(F.col("o_A").isNotNull() & F.col("o_D").isNotNull() & F.col("o_H").isNotNull())
    weights = [i / BLEND_STEPS for i in range(BLEND_STEPS + 1)]
    row = ready.agg(*[F.avg(negative_log(w * model + (1 - w) * market)).alias(f"a{i}") for i, w in enumerate(weights)])
    cells = [F.struct(F.lit(w).alias("alpha"), F.col(f"a{i}").alias("log_loss")) for i, w in enumerate(weights)]
    return row.select(F.explode(F.array(*cells)).alias("e")).select("e.*")


def blend_search(df: DataFrame, label: str = "y_outcome") -> DataFrame:
    """The weight with the smallest loss; the smaller weight wins a tie."""
    best = F.min(F.struct("log_loss", "alpha")).alias("best")
    return blend_losses(df, label).agg(best).select("best.alpha", "best.log_loss")


def blended(df: DataFrame, alpha: float | Column) -> DataFrame:
    """p_* replaced by the blend; rows the market does not cover are left out."""
    weight = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    ready = df.where(F.col("o_A").isNotNull() & F.col("o_D").isNotNull() & F.col("o_H").isNotNull())
    return ready.withColumns(
        {f"p_{c}": weight * F.col(f"p_{c}") + (1 - weight) * F.col(f"o_{c}") for c in LABELS}
    )
