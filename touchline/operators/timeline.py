"""Ordered work over teams of any size: a team's timeline in spans, and what each span takes over.

Windows run per (team, span). What a span needs from the spans before it is a summary of a few values,
which spans combine in order: the last rows, a count, the places of breaks. No team is counted first and
none is treated apart, so a team that plays in a third of all matches is many spans like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Sorts behind every real slot and name: missing values come last.
LAST_SLOT = 2**62
LAST_NAME = "\U0010ffff"
# Length of a span. Rows without a date have no days to cut at; their spans are slot, division and opponent.
SPAN_DAYS = 366
TEAM = "team_key"
SPAN = ["span", "span_division", "span_opponent"]
KEYS = [TEAM, *SPAN]


def spanned(view: DataFrame, span_days: int = SPAN_DAYS) -> DataFrame:
    """Team rows with the key of their team and the span they lie in; spans sort as their rows do."""
    dated = F.col("slot") < LAST_SLOT
    return view.withColumns(
        {
            TEAM: F.coalesce("team", F.lit(LAST_NAME)),
            "span": F.when(dated, F.floor(F.unix_date("match_date") / span_days)).otherwise(F.col("slot")),
            "span_division": F.when(dated, "").otherwise(F.col("division_key")),
            "span_opponent": F.when(dated, "").otherwise(F.col("opponent_key")),
        }
    )


def last_rows(rows: DataFrame, order: list[str], fields: list[str], depth: int) -> DataFrame:
    """KEYS + ``before``: the last ``depth`` rows of the team before each span, latest first.

    Before the shuffle a task keeps at most ``depth`` rows of a span (a limit on a row number).
    """
    latest = Window.partitionBy(*KEYS).orderBy(*[F.desc(c) for c in order])
    kept = rows.select(*dict.fromkeys([*KEYS, *order, *fields])).withColumn("back", F.row_number().over(latest)).where(F.col("back") <= depth)
    entry = F.struct("back", *fields)
    summary = kept.groupBy(*KEYS).agg(F.array_sort(F.collect_list(entry)).alias("tail"))
    # Every span has a row, so `depth` earlier spans hold at least `depth` rows; read backwards, the latest comes first.
    earlier = Window.partitionBy(TEAM).orderBy(*[F.desc(c) for c in SPAN]).rowsBetween(1, depth)
    return summary.select(*KEYS, F.slice(F.flatten(F.collect_list("tail").over(earlier)), 1, depth).alias("before"))
