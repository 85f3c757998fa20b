"""Player rows of two layouts brought to one, and rolled up to team level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.casts import ratio, to_double, to_int
from touchline.functions.text import title_away, title_date, title_home
from touchline.sources.ragged import TAIL

TEXT_STATS = ("player", "nation", "pos", "age")
# The shared stat columns in output order; decimals are the double ones.
NUMBER_STATS = (
    "min gls ast pk pkatt sh sot crdy crdr fls fld off crs tklw tkl intr blocks og pkwon pkcon touches "
    "xg npxg xag sca gca pass_cmp pass_att pass_cmp_pct pass_prg carries carries_prg take_ons_att take_ons_succ"
).split()
DECIMAL_STATS = {"xg", "npxg", "xag", "pass_cmp_pct"}

# Which field of a row holds which stat (field 2 is not used).
OLD_LAYOUT = {
    "player": 1, "nation": 3, "pos": 4, "age": 5, "min": 6, "gls": 7, "ast": 8, "pk": 9, "pkatt": 10, "sh": 11,
    "sot": 12, "crdy": 13, "crdr": 14, "fls": 15, "fld": 16, "off": 17, "crs": 18, "tklw": 19, "intr": 20, "og": 21,
    "pkwon": 22, "pkcon": 23,
}
NEW_LAYOUT = {
    "player": 1, "nation": 3, "pos": 4, "age": 5, "min": 6, "gls": 7, "ast": 8, "pk": 9, "pkatt": 10, "sh": 11,
    "sot": 12, "crdy": 13, "crdr": 14, "touches": 15, "tkl": 16, "intr": 17, "blocks": 18, "xg": 19, "npxg": 20, "xag": 21,
    "sca": 22, "gca": 23, "pass_cmp": 24, "pass_att": 25, "pass_cmp_pct": 26, "pass_prg": 27, "carries": 28, "carries_prg": 29, "take_ons_att": 30, "take_ons_succ": 31,
}

TEAM_KEYS = ("match_url", "league_slug", "season_end", "team_hint")
# Stat -> name of its team sum.
TEAM_SUMS = {
    "min": "min_sum", "gls": "gls_sum", "ast": "ast_sum", "pk": "pk_sum", "pkatt": "pkatt_sum", "sh": "sh_sum",
    "sot": "sot_sum", "crdy": "yel_sum", "crdr": "red_sum", "fls": "fls_sum", "fld": "fld_sum", "off": "off_sum",
    "crs": "crs_sum", "tklw": "tklw_sum", "tkl": "tkl_sum", "intr": "int_sum", "blocks": "blk_sum", "xg": "xg_sum",
    "npxg": "npxg_sum", "xag": "xag_sum", "sca": "sca_sum", "gca": "gca_sum", "pass_cmp": "pass_cmp_sum", "pass_att": "pass_att_sum",
    "pass_prg": "pass_prg_sum", "carries": "carries_sum", "carries_prg": "carries_prg_sum", "take_ons_att": "take_att_sum", "take_ons_succ": "take_succ_sum",
}
# Sums that are also given per 90 minutes.
PER_90 = ("gls", "ast", "sh", "sot", "xg", "sca", "pass_prg")


def player_rows(df: DataFrame) -> DataFrame:
    """Summary rows of players, without the footer line that counts them."""
    footer = F.coalesce(F.lower("c01"), F.lit("")).contains("players")
    return df.where((F.lower("table_type") == "summary") & ~footer)


def _cast(text: Column, name: str) -> Column:
    if name in TEXT_STATS:
        return text
    if name == "pass_cmp_pct":
        text = F.replace(text, F.lit("%"), F.lit(""))
    return to_double(text) if name in DECIMAL_STATS else to_int(text)


def _nothing(name: str) -> Column:
    return F.lit(None).cast("string" if name in TEXT_STATS else "double" if name in DECIMAL_STATS else "int")


def harmonise(df: DataFrame, layout: dict[str, int]) -> DataFrame:
    """Player rows of one layout under the shared names; stats the layout lacks are NULL."""
    columns = [
        (_cast(F.col(f"c{layout[n]:02d}"), n) if n in layout else _nothing(n)).alias(n)
        for n in (*TEXT_STATS, *NUMBER_STATS)
    ]
    return player_rows(df).select(*columns, *TAIL)


def harmonise_players(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both layouts, each from a table of its own."""
    return harmonise(old, OLD_LAYOUT).unionByName(harmonise(new, NEW_LAYOUT))


def harmonise_split(split: DataFrame) -> DataFrame:
    """Both layouts straight from the ragged splitter, in one pass over its rows.

    The place of a stat depends on the era of the row, so nothing has to be read
    once per layout and put together again.
    """
    summary = F.lower("table_type") == "summary"
    footer = F.coalesce(F.lower(F.get("fields", F.lit(0))), F.lit("")).contains("players")
    rows = split.where(F.col("tag").startswith("summary_") & summary & ~footer)
    is_new = F.col("tag") == "summary_neu"

    def text(name: str) -> Column:
        old, new = (F.lit(p.get(name, 0) - 1) for p in (OLD_LAYOUT, NEW_LAYOUT))
        # An index of -1 is out of range and gives NULL.
        return F.get("fields", old if OLD_LAYOUT.get(name) == NEW_LAYOUT.get(name) else F.when(is_new, new).otherwise(old))

    return rows.select(*[_cast(text(n), n).alias(n) for n in (*TEXT_STATS, *NUMBER_STATS)], *TAIL)


def union_loose(frames: list[DataFrame]) -> DataFrame:
    """Union of frames with different columns; absent ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def team_aggregate(players: DataFrame) -> DataFrame:
    """Sums per match and team, and rates from the sums (NULL when the base is not positive)."""
    sums = [F.sum(s).alias(name) for s, name in TEAM_SUMS.items()]
    teams = players.groupBy(*TEAM_KEYS).agg(*sums, F.avg("pass_cmp_pct").alias("pass_cmp_pct_avg"))

    def rate(top: str, factor: float, base: str) -> Column:
        return F.when(F.col(base) > 0, ratio(F.col(top) * F.lit(factor), F.col(base).cast("double")))

    per_90 = {f"{s}_p90": rate(TEAM_SUMS[s], 90.0, "min_sum") for s in PER_90}
    return teams.withColumns({**per_90, "take_on_succ_rate": rate("take_succ_sum", 1.0, "take_att_sum")})


def match_titles(players: DataFrame) -> DataFrame:
    """One title per match: the smallest, so that a rerun gives the same."""
    return players.groupBy("match_url").agg(F.min("match_title").alias("match_title"))


def parse_titles(df: DataFrame, title: str = "match_title") -> DataFrame:
    """Home team, away team and date text taken from the report title."""
    return df.withColumns(
        {
            "home_team_fb": title_home(title),
            "away_team_fb": title_away(title),
            "match_date_fb": title_date(title),
        }
    )


def enrich_titles(teams: DataFrame, players: DataFrame) -> DataFrame:
    """Team rows with the title of their match and its parts."""
    return parse_titles(teams.join(match_titles(players), "match_url", "left"))


def duplicate_keys(df: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """Keys that occur more than once, most frequent first when ``n`` asks for the top."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)
    return found.orderBy(F.desc("cnt"), *keys).limit(n) if n else found


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    return df.join(duplicate_keys(df, keys).drop("cnt"), keys, "left_semi")
