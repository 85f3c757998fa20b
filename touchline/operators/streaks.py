"""Length of the run a team brings into each match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.history import ORDER
from touchline.operators.timeline import KEYS, SPAN, SPAN_DAYS, TEAM, spanned

# Kind of streak -> the rows that end it.
BREAKS = {
    "win": "win <> 1",
    "losing": "loss <> 1",
    "nowin": "win = 1",
    "noloss": "loss = 1",
}
# Kinds the literal reading numbers from the end of the run backwards.
COUNTED_BACK = ("nowin", "noloss")


def _result_letter() -> Column:
    return (
        F.when(F.col("goals_for") > F.col("goals_against"), "W")
        .when(F.col("goals_for") == F.col("goals_against"), "D")
        .otherwise("L")
    )


def streaks(view: DataFrame, mode: str = "documented", span_days: int = SPAN_DAYS) -> DataFrame:
    """Win, losing, no-win and no-loss streak before each match of a team view.

    A run is the distance to the last row that broke it, so spans of a team take
    over a number of rows and the places of breaks (see ``timeline``).

    ``documented``  the run counts up while its condition holds and starts at 1;
    ``as_written``  the break row is numbered as part of the run (a win streak
                    after a break starts at 2), and the no-win and no-loss runs
                    count down to their end, which looks into the future.
    """
    if mode not in ("documented", "as_written"):
        raise ValueError(f"unknown streak mode: {mode}")
    placed = spanned(view, span_days)
    w = Window.partitionBy(*KEYS).orderBy(*ORDER)
    so_far = w.rowsBetween(Window.unboundedPreceding, -1)
    to_come = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)

    rows = placed.withColumn("pos", F.row_number().over(w).cast("bigint"))
    breaks = {kind: F.when(F.expr(cond), F.col("pos")) for kind, cond in BREAKS.items()}
    running = {f"last_{k}": F.max(b).over(so_far) for k, b in breaks.items()}
    if mode == "as_written":
        running |= {f"next_{k}": F.min(breaks[k]).over(to_come) for k in COUNTED_BACK}
        running["span_size"] = F.count(F.lit(1)).over(Window.partitionBy(*KEYS))
    local = rows.withColumns(running)

    joined = local.join(_carried(rows, breaks), KEYS)
    offset = F.col("offset")
    place = offset + F.col("pos")
    out = {}
    for kind in BREAKS:
        last = F.coalesce(offset + F.col(f"last_{kind}"), F.col(f"before_{kind}"))
        if mode == "documented":
            value = place - 1 - F.coalesce(last, F.lit(0))
        elif kind not in COUNTED_BACK:
            value = F.when(last.isNull(), place - 1).when(last == place - 1, 0).otherwise(place - last)
        else:
            total = offset + F.col("span_size") + F.coalesce("rows_after", F.lit(0))
            upcoming = F.coalesce(offset + F.col(f"next_{kind}"), F.col(f"after_{kind}"), total + 1)
            idle = (place == 1) | F.coalesce(last == place - 1, F.lit(False))
            value = F.when(idle, 0).otherwise(upcoming - (place - 1))
        out[f"{kind}_streak_in"] = value.cast("bigint")
    return joined.select(
        "match_id",
        "side",
        "match_date",
        "match_time_sort",
        "Division",
        "team",
        "opponent",
        "goals_for",
        "goals_against",
        _result_letter().alias("result"),
        *[c.alias(n) for n, c in out.items()],
    )


def _carried(rows: DataFrame, breaks: dict[str, Column]) -> DataFrame:
    """For each span: rows of the team before and after it, nearest breaks on both sides."""
    measures = {"span_rows": F.count(F.lit(1))}
    for kind, position in breaks.items():
        measures[f"first_{kind}"] = F.min(position)
        measures[f"final_{kind}"] = F.max(position)
    totals = rows.groupBy(*KEYS).agg(*[c.alias(n) for n, c in measures.items()])
    by_span = Window.partitionBy(TEAM).orderBy(*SPAN)
    earlier = by_span.rowsBetween(Window.unboundedPreceding, -1)
    later = by_span.rowsBetween(1, Window.unboundedFollowing)
    shifted = totals.withColumn("offset", F.coalesce(F.sum("span_rows").over(earlier), F.lit(0)))
    return shifted.select(
        *KEYS,
        "offset",
        F.sum("span_rows").over(later).alias("rows_after"),
        *[F.max(F.col("offset") + F.col(f"final_{k}")).over(earlier).alias(f"before_{k}") for k in breaks],
        *[F.min(F.col("offset") + F.col(f"first_{k}")).over(later).alias(f"after_{k}") for k in breaks],
    )


def latest_matches(streak_rows: DataFrame, n: int = 20, team: str | None = None) -> DataFrame:
    """The last ``n`` rows of each team, or of one team, newest first.

    Per team Spark keeps at most ``n`` rows of a team in each task before the
    shuffle (a limit on a row number), so a team of any size is cheap.
    """
    newest = [F.desc_nulls_last(c) for c in ("match_date", "match_time_sort", "Division", "opponent", "match_id")]
    if team is not None:
        return streak_rows.where(F.col("team") == team).orderBy(*newest).limit(n)
    place = F.row_number().over(Window.partitionBy("team").orderBy(*newest))
    return streak_rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
