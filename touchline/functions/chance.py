"""Probability and odds expressions shared by evaluation and betting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.casts import col

# Outcome labels in model order, and the smallest probability a loss may see.
LABELS = ("A", "D", "H")
LOSS_FLOOR = 1e-15


def add_up(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def inverse_odds(odds: str | Column) -> Column:
    """Implied probability 1/odds; NULL for a zero or missing price."""
    return F.try_divide(F.lit(1.0), col(odds))


def first_maximum(values: list[Column], labels: tuple[str, ...]) -> Column:
    """Label of the largest value; the first one wins a tie, a missing value wins over all."""
    cells = F.array(*[F.coalesce(v.cast("double"), F.lit(float("nan"))) for v in values])
    place = F.array_position(cells, F.array_max(cells)).cast("int")
    return F.get(F.array(*[F.lit(x) for x in labels]), place - 1)


def pick(label: Column, by_label: dict[str, Column]) -> Column:
    """The value that belongs to the label in each row."""
    out = F.lit(None)
    for name, value in by_label.items():
        out = F.when(label == name, value).otherwise(out)
    return out


def negative_log(p: Column) -> Column:
    """Loss of the probability given to what happened, kept finite."""
    return -F.ln(F.least(F.greatest(p, F.lit(LOSS_FLOOR)), F.lit(1.0 - LOSS_FLOOR)))


def kelly_fraction(p: Column, odds: Column) -> Column:
    """Share of the bank to stake at decimal odds; 0 when the price or the chance gives no gain."""
    gain = odds - 1.0
    stake = F.try_divide(gain * p - (1.0 - p), gain)
    return F.when(gain > 0, F.greatest(stake, F.lit(0.0))).otherwise(F.lit(0.0))
