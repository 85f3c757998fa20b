"""Match rows to model features, as far as the columns at hand allow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.casts import ratio, to_date, to_double, to_int
from touchline.functions.chance import add_up, inverse_odds

REQUIRED = ("Division", "MatchDate", "HomeTeam", "AwayTeam")

# Columns kept from a wide match table.
KEEP = (
    "Division MatchDate MatchTime HomeTeam AwayTeam HomeElo AwayElo Form3Home Form5Home Form3Away Form5Away "
    "FTHome FTAway FTResult HTHome HTAway HTResult OddHome OddDraw OddAway MaxHome MaxDraw MaxAway "
    "HomeShots AwayShots HomeTarget AwayTarget HomeFouls AwayFouls HomeCorners AwayCorners "
    "HomeYellow AwayYellow HomeRed AwayRed"
).split()


def keep_columns(df: DataFrame, keep: list[str] | tuple[str, ...] = tuple(KEEP)) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, in the wanted order, and the names that do not."""
    present = [c for c in keep if c in df.columns]
    if not present:
        raise ValueError("none of the wanted columns exists")
    return df.select(*present), [c for c in keep if c not in df.columns]


def require(df: DataFrame, columns: list[str] | tuple[str, ...] = REQUIRED) -> DataFrame:
    """Stop before any job runs when a needed column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


# Columns read as whole numbers; every other number is a double.
WHOLE = ("FTHome", "FTAway", "HTHome", "HTAway")
# Columns that stay text.
TEXT = ("Division", "MatchDate", "MatchTime", "HomeTeam", "AwayTeam", "FTResult", "HTResult")


def typed_inputs(matches: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The known columns of a raw match table, each number cast once from text."""
    numbers = [c for c in KEEP if c in matches.columns and c not in TEXT]
    return matches.select(
        *carry,
        *[c for c in TEXT if c in matches.columns],
        *[(to_int(c) if c in WHOLE else to_double(c)).alias(c) for c in numbers],
    )


def _difference(home: str, away: str, name: str) -> Callable[[], list[Column]]:
    """Both sides, and home minus away."""

    def build() -> list[Column]:
        return [F.col(home), F.col(away), (F.col(home) - F.col(away)).alias(name)]

    return build


def _outcome(unplayed: str) -> list[Column]:
    home, away = F.col("FTHome"), F.col("FTAway")
    label = F.when(home > away, "H").when(home < away, "A").otherwise("D")
    won = F.when(home > away, 1).otherwise(0)
    if unplayed == "null":
        played = home.isNotNull() & away.isNotNull()
        label, won = F.when(played, label), F.when(played, won)
    return [home, away, label.alias("y_outcome"), won.alias("y_home_win")]


def _outcome_from_result() -> list[Column]:
    nothing = F.lit(None).cast("int")
    return [
        F.coalesce("FTResult", F.lit("")).alias("FTResult"),
        nothing.alias("FTHome"),
        nothing.alias("FTAway"),
        F.col("FTResult").alias("y_outcome"),
        F.when(F.col("FTResult") == "H", 1).otherwise(0).alias("y_home_win"),
    ]


def _no_outcome() -> list[Column]:
    return [F.lit(None).cast("string").alias("y_outcome"), F.lit(None).cast("int").alias("y_home_win")]


def _half_time() -> list[Column]:
    return [F.col("HTHome"), F.col("HTAway"), F.coalesce("HTResult", F.lit("")).alias("HTResult")]


def _elo() -> list[Column]:
    h, a = F.col("HomeElo"), F.col("AwayElo")
    return [*_difference("HomeElo", "AwayElo", "elo_diff")(), ratio(h, h + a).alias("elo_ratio")]


def odds_implied() -> list[Column]:
    """Prices, what they imply, the bookmaker's margin, and the shares without it."""
    prices = {"h": "OddHome", "d": "OddDraw", "a": "OddAway"}
    implied = {k: inverse_odds(c) for k, c in prices.items()}
    total = add_up(list(implied.values()))
    return [
        *[F.col(c) for c in prices.values()],
        *[q.alias(f"q{k}") for k, q in implied.items()],
        total.alias("qsum"),
        *[ratio(implied[k], total).alias(f"p_{n}") for k, n in (("h", "home"), ("d", "draw"), ("a", "away"))],
        total.alias("overround"),
    ]


def _best_odds() -> list[Column]:
    names = ("MaxHome", "MaxDraw", "MaxAway")

    def log_price(c: str) -> Column:
        return F.ln(F.when(F.col(c) > 0, F.col(c)))

    return [*names, (log_price("MaxAway") - log_price("MaxHome")).alias("log_odds_away_vs_home")]


def _accuracy() -> list[Column]:
    home = ratio(F.col("HomeTarget"), F.col("HomeShots"))
    away = ratio(F.col("AwayTarget"), F.col("AwayShots"))
    return [home.alias("shot_acc_home"), away.alias("shot_acc_away"), (home - away).alias("shot_acc_diff")]


def _dominance() -> list[Column]:
    corners = F.col("HomeCorners") - F.col("AwayCorners")
    shots = F.col("HomeShots") - F.col("AwayShots")
    return [((corners + shots) / F.lit(2.0)).alias("dominance_index")]


def _momentum(side: str) -> Callable[[], list[Column]]:
    def build() -> list[Column]:
        gain = F.col(f"Form5{side}") - F.col(f"Form3{side}")
        return [gain.alias(f"form_momentum_{side.lower()}")]

    return build


# Each family appears when all the columns it reads exist.
FAMILIES: tuple[tuple[tuple[str, ...], Callable[[], list[Column]]], ...] = (
    (("HTHome", "HTAway", "HTResult"), _half_time),
    (("HomeElo", "AwayElo"), _elo),
    (("Form3Home", "Form3Away"), _difference("Form3Home", "Form3Away", "form3_diff")),
    (("Form5Home", "Form5Away"), _difference("Form5Home", "Form5Away", "form5_diff")),
    (("OddHome", "OddDraw", "OddAway"), odds_implied),
    (("OddHome", "OddDraw", "OddAway", "MaxHome", "MaxDraw", "MaxAway"), _best_odds),
    (("HomeShots", "AwayShots"), _difference("HomeShots", "AwayShots", "shots_diff")),
    (("HomeTarget", "AwayTarget"), _difference("HomeTarget", "AwayTarget", "shots_on_target_diff")),
    (("HomeTarget", "AwayTarget", "HomeShots", "AwayShots"), _accuracy),
    (("HomeFouls", "AwayFouls"), _difference("HomeFouls", "AwayFouls", "fouls_diff")),
    (("HomeYellow", "AwayYellow"), _difference("HomeYellow", "AwayYellow", "yellow_diff")),
    (("HomeRed", "AwayRed"), _difference("HomeRed", "AwayRed", "red_diff")),
    (("HomeCorners", "AwayCorners"), _difference("HomeCorners", "AwayCorners", "corners_diff")),
    (("HomeCorners", "AwayCorners", "HomeShots", "AwayShots"), _dominance),
    (("Form5Home", "Form3Home"), _momentum("Home")),
    (("Form5Away", "Form3Away"), _momentum("Away")),
)


def build_features(matches: DataFrame, unplayed: str = "draw", carry: tuple[str, ...] = ()) -> DataFrame:
    """Base features of each match: one projection that casts, one that derives.

    ``unplayed``  a match without a score is labelled a draw ("draw") or not at all ("null");
    ``carry``     further columns to pass through, such as a row id.
    """
    if unplayed not in ("draw", "null"):
        raise ValueError(f"unknown handling of unplayed matches: {unplayed}")
    require(matches)
    has = set(matches.columns)
    kick_off = F.coalesce("MatchTime", F.lit("")) if "MatchTime" in has else F.lit("")
    ids = [F.col(c).cast("string") for c in REQUIRED]
    columns = [
        *[F.col(c) for c in carry],
        "Division",
        "MatchDate",
        kick_off.alias("MatchTime"),
        "HomeTeam",
        "AwayTeam",
        to_date("MatchDate").alias("match_date"),
        F.concat_ws("|", *ids).alias("cfmd_match_id"),
    ]
    if {"FTHome", "FTAway"} <= has:
        columns += _outcome(unplayed)
    elif "FTResult" in has:
        columns += _outcome_from_result()
    else:
        columns += _no_outcome()
    for inputs, build in FAMILIES:
        if has.issuperset(inputs):
            columns += build()
    return typed_inputs(matches, carry).select(*columns)


def label_summary(features: DataFrame) -> DataFrame:
    """Rows, and rows that carry a label."""
    return features.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("y_outcome").isNotNull()).alias("rows_with_label")
    )


def fill_derived(df: DataFrame, formula: str = "training") -> DataFrame:
    """Fill derived columns where they are missing or 0, in order of dependence.

    Only columns that exist are filled. ``formula="form"`` follows the entry form
    where it differs from training: the rating ratio is home/away and the log
    price comes from the plain odds instead of the best odds.
    """
    if formula not in ("training", "form"):
        raise ValueError(f"unknown formula set: {formula}")

    def number(c: str) -> Column:
        return F.col(c).cast("double")

    def fill(frame: DataFrame, rules: dict[str, tuple[tuple[str, ...], Column]]) -> DataFrame:
        new = {}
        for name, (needs, value) in rules.items():
            if name in frame.columns and set(needs) <= set(frame.columns):
                unset = number(name).isNull() | (number(name) == 0)
                new[name] = F.when(unset, value).otherwise(number(name))
        return frame.withColumns(new) if new else frame

    elo_base = number("AwayElo") if formula == "form" else number("HomeElo") + number("AwayElo")
    prices = ("OddAway", "OddHome") if formula == "form" else ("MaxAway", "MaxHome")
    odds = ("OddHome", "OddDraw", "OddAway")
    shares = ("qh", "qd", "qa")
    known = [F.coalesce(number(q), F.lit(0.0)) for q in shares]
    some = F.coalesce(*[number(q) for q in shares]).isNotNull()
    positive = (number(prices[0]) > 0) & (number(prices[1]) > 0)

    out = fill(
        df,
        {
            "elo_diff": (("HomeElo", "AwayElo"), number("HomeElo") - number("AwayElo")),
            "elo_ratio": (("HomeElo", "AwayElo"), ratio(number("HomeElo"), elo_base)),
            "form3_diff": (("Form3Home", "Form3Away"), number("Form3Home") - number("Form3Away")),
            "form5_diff": (("Form5Home", "Form5Away"), number("Form5Home") - number("Form5Away")),
            "shot_acc_diff": (("shot_acc_home", "shot_acc_away"), number("shot_acc_home") - number("shot_acc_away")),
            **{q: (odds, inverse_odds(number(o))) for q, o in zip(shares, odds)},
            "log_odds_away_vs_home": (
                (*odds, *prices),
                F.when(positive, F.ln(ratio(number(prices[0]), number(prices[1])))),
            ),
        },
    )
    out = fill(out, {"qsum": ((*odds, *shares), F.when(some, add_up(known)))})
    probabilities = ("p_home", "p_draw", "p_away")
    out = fill(
        out,
        {
            **{
                p: ((*odds, *shares, *probabilities, "qsum"), ratio(number(q), number("qsum")))
                for p, q in zip(probabilities, shares)
            },
            "overround": ((*odds, "qsum"), number("qsum")),
        },
    )
    return out
