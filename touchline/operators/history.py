"""Team history: two rows per match, and what each team did in its matches before."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.casts import to_date, to_double, to_int, to_seconds
from touchline.functions.chance import add_up
from touchline.operators.timeline import KEYS, LAST_NAME, LAST_SLOT, SPAN_DAYS, last_rows, spanned
from touchline.session import drop_tables, write_table

DAY = 86_400
# The deepest frame looks six matches back.
DEPTH = 6

# Total order of a team's matches: date, kick-off, division, opponent, then ids.
ORDER = ["slot", "division_key", "opponent_key", "match_id", "side"]

LAGGED = [
    "gf_last3",
    "ga_last3",
    "pts_last3",
    "elo_trend3",
    "gf_last5",
    "ga_last5",
    "pts_last5",
    "elo_trend5",
    "rest_days",
    "form_momentum",
]


def base_rows(matches: DataFrame, match_id: str, carry: Sequence[str] = ()) -> DataFrame:
    """The columns history needs, cast from text or already typed, and those to ``carry``."""
    has = dict(matches.dtypes)

    def number(c: str, kind: str, cast: Callable[[str], Column]) -> Column:
        # A number of the wanted type is not written out and read again.
        return F.col(c) if has.get(c) == kind else cast(c)

    return matches.select(
        *carry,
        F.col(match_id).alias("match_id"),
        to_date("MatchDate").alias("match_date"),
        (to_seconds("MatchTime") if "MatchTime" in has else F.lit(0)).alias("match_time_sort"),
        "Division",
        "HomeTeam",
        "AwayTeam",
        number("FTHome", "int", to_int).alias("FTHome"),
        number("FTAway", "int", to_int).alias("FTAway"),
        (number("HomeElo", "double", to_double) if "HomeElo" in has else F.lit(None).cast("double")).alias("HomeElo"),
        (number("AwayElo", "double", to_double) if "AwayElo" in has else F.lit(None).cast("double")).alias("AwayElo"),
    )


def team_view(matches: DataFrame, match_id: str = "match_id", carry: Sequence[str] = ()) -> DataFrame:
    """Each match once per team, in one pass over the matches; columns to ``carry`` come first.

    A match without a score counts as no win, no draw, no loss and no points.
    """

    def seen_from(side: str, team: str, opponent: str, gf: str, ga: str, elo: str) -> Column:
        won, drew, lost = (F.col(gf) > F.col(ga), F.col(gf) == F.col(ga), F.col(gf) < F.col(ga))
        return F.struct(
            F.lit(side).alias("side"),
            F.col(team).alias("team"),
            F.col(opponent).alias("opponent"),
            F.col(gf).alias("goals_for"),
            F.col(ga).alias("goals_against"),
            F.col(elo).alias("elo"),
            F.when(won, 3).when(drew, 1).otherwise(0).alias("points"),
            F.when(won, 1).otherwise(0).alias("win"),
            F.when(drew, 1).otherwise(0).alias("draw"),
            F.when(lost, 1).otherwise(0).alias("loss"),
        )

    both = F.array(
        seen_from("home", "HomeTeam", "AwayTeam", "FTHome", "FTAway", "HomeElo"),
        seen_from("away", "AwayTeam", "HomeTeam", "FTAway", "FTHome", "AwayElo"),
    )
    day_start = F.coalesce(F.unix_date("match_date").cast("bigint") * DAY, F.lit(LAST_SLOT))
    slot = day_start + F.col("match_time_sort")
    return (
        base_rows(matches, match_id, carry)
        .select(*carry, "match_id", "match_date", "match_time_sort", "Division", slot.alias("slot"), F.explode(both).alias("v"))
        .select(
            *carry,
            "match_id",
            "match_date",
            "match_time_sort",
            "Division",
            "v.*",
            "slot",
            F.coalesce("Division", F.lit(LAST_NAME)).alias("division_key"),
            F.coalesce("v.opponent", F.lit(LAST_NAME)).alias("opponent_key"),
        )
    )


# What a row needs of each of the rows before it: column -> how far back.
BACK = {"goals_for": 5, "goals_against": 5, "points": DEPTH, "elo": DEPTH, "match_date": 1}


def _total(values: list[Column]) -> Column:
    """Sum of the values there are; NULL if there is none."""
    return F.when(F.coalesce(*values).isNotNull(), add_up([F.coalesce(v, F.lit(0)) for v in values]))


def _mean(values: list[Column]) -> Column:
    filled = add_up([v.isNotNull().cast("int") for v in values])
    return F.when(filled > 0, add_up([F.coalesce(v, F.lit(0.0)) for v in values]) / F.when(filled > 0, filled))


def rolling(view: DataFrame, span_days: int = SPAN_DAYS) -> DataFrame:
    """Pre-match figures of each team row, from earlier matches only.

    Rating change and rest since the last match, goals and points over the last
    three and five, mean rating change over the same, and points of the last
    three less those of the three before. Rows are shuffled and sorted once; the
    last rows of earlier spans join their span.
    """
    rows = spanned(view, span_days)
    w = Window.partitionBy(*KEYS).orderBy(*ORDER)
    back = {f"{c}_{k}": F.lag(c, k).over(w) for c, deep in BACK.items() for k in range(1, deep + 1)}
    local = rows.withColumns({"place": F.row_number().over(w), **back})
    joined = local.join(last_rows(rows, ORDER, list(BACK), DEPTH), KEYS)

    def past(c: str, k: int) -> Column:
        """Column ``c`` of the k-th row before, which may lie in an earlier span."""
        return F.when(F.col("place") > k, F.col(f"{c}_{k}")).otherwise(F.get("before", k - F.col("place"))[c])

    def last(c: str, first: int, upto: int) -> list[Column]:
        return [past(c, k) for k in range(upto, first - 1, -1)]

    def changes(upto: int) -> list[Column]:
        return [past("elo", k) - past("elo", k + 1) for k in range(upto, 0, -1)]

    out = {
        "elo_change": F.col("elo") - past("elo", 1),
        "rest_days": F.datediff("match_date", past("match_date", 1)),
        "gf_last3": _total(last("goals_for", 1, 3)).cast("bigint"),
        "ga_last3": _total(last("goals_against", 1, 3)).cast("bigint"),
        "pts_last3": _total(last("points", 1, 3)).cast("bigint"),
        "elo_trend3": _mean(changes(3)),
        "gf_last5": _total(last("goals_for", 1, 5)).cast("bigint"),
        "ga_last5": _total(last("goals_against", 1, 5)).cast("bigint"),
        "pts_last5": _total(last("points", 1, 5)).cast("bigint"),
        "elo_trend5": _mean(changes(5)),
        "form_momentum": (_total(last("points", 1, 3)) - _total(last("points", 4, 6))).cast("bigint"),
    }
    kept = [c for c in view.columns if c not in ("slot", "division_key", "opponent_key")]
    return joined.select(*kept, *[c.alias(n) for n, c in out.items()])


def attach_rolling(
    matches: DataFrame, history: DataFrame, match_id: str = "match_id", attach: str = "match_id"
) -> DataFrame:
    """Bring the home and the away history back to the match row; ``match_id`` must be unique.

    ``match_id``   one output row per match (default);
    ``three_key``  joins on team, date and kick-off: a team with two matches at
                   one time multiplies rows, undated matches find no history.
    """
    if attach == "match_id":
        sides = history.groupBy("match_id").agg(
            *[
                F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{c}")
                for side in ("home", "away")
                for c in LAGGED
            ]
        )
        return matches.join(sides.withColumnRenamed("match_id", match_id), match_id, "left")
    if attach != "three_key":
        raise ValueError(f"unknown attach mode: {attach}")
    out = matches.withColumns(
        {
            "_date": to_date("MatchDate"),
            "_time": to_seconds("MatchTime") if "MatchTime" in matches.columns else F.lit(0),
        }
    )
    for side, team in (("home", "HomeTeam"), ("away", "AwayTeam")):
        part = history.select(
            F.col("team").alias(team),
            F.col("match_date").alias("_date"),
            F.col("match_time_sort").alias("_time"),
            *[F.col(c).alias(f"{side}_{c}") for c in LAGGED],
        )
        out = out.join(part, [team, "_date", "_time"], "left")
    return out.select(*matches.columns, *[f"{side}_{c}" for side in ("home", "away") for c in LAGGED])


def lagged_features(
    matches: DataFrame, match_id: str = "match_id", attach: str = "match_id", span_days: int = SPAN_DAYS
) -> DataFrame:
    """Match rows with ten history columns for each side."""
    history = rolling(team_view(matches, match_id), span_days)
    return attach_rolling(matches, history, match_id, attach)


# What ``rolling`` and the way back to the match read of a team row.
_ROLLED = ["match_id", "side", "match_date", "team", "goals_for", "goals_against", "elo", "points", "slot", "division_key", "opponent_key"]


def sliced_lagged_features(
    matches: DataFrame, slices: int, match_id: str = "match_id", span_days: int = SPAN_DAYS, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """``lagged_features`` by match id, written in ``slices`` steps, so that the shuffles of one step are on disk at a time.

    ``matches`` is a table written with a folder for each slice, ``slice_of`` of the match id, as ``_slice``. Team rows
    are written by slices of the teams, their history by slices of the matches, so that a step reads its folders
    alone. ``finish`` is applied to the rows of each step. Starts jobs.
    """
    team = slice_of(F.coalesce("team", F.lit(LAST_NAME)), slices)
    view = write_table(team_view(matches.drop("_slice"), match_id).select(*_ROLLED, team.alias("_team")), ["_team"], codec="zstd")
    mine = slice_of(F.col("match_id"), slices).alias("_slice")
    steps = [rolling(view.where(F.col("_team") == k).drop("_team"), span_days).select("match_id", "side", *LAGGED, mine) for k in range(slices)]
    history = write_table(steps[0], ["_slice"], steps[1:], "zstd")
    drop_tables(view)
    both = [[df.where(F.col("_slice") == k).drop("_slice") for df in (matches, history)] for k in range(slices)]
    steps = [finish(attach_rolling(own, past, match_id)) for own, past in both]
    out = write_table(steps[0], more=steps[1:], codec="zstd")
    drop_tables(history)
    return out


def slice_of(key: Column, slices: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")
