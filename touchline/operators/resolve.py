"""Finding the match row that belongs to a match report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.casts import to_date, to_long_date

# Division codes of the five leagues the report source covers.
BIG_FIVE = ("E0", "SP1", "F1", "D1", "I1")


def filter_divisions(matches: DataFrame, codes: tuple[str, ...] = BIG_FIVE) -> DataFrame:
    return matches.where(F.col("Division").isin(*codes))


def with_match_id(matches: DataFrame) -> DataFrame:
    """Match id from division, date as written, and the two teams; missing parts are skipped."""
    parts = [F.col(c).cast("string") for c in ("Division", "MatchDate", "HomeTeam", "AwayTeam")]
    return matches.withColumn("cfmd_match_id", F.concat_ws("|", *parts))


def report_feed(enriched: DataFrame) -> DataFrame:
    """match_url, both teams and the parsed date of the reports that name two teams."""
    return enriched.dropna(subset=["home_team_fb", "away_team_fb"]).select(
        "match_url", "home_team_fb", "away_team_fb", to_long_date("match_date_fb").alias("match_date_fb")
    )


def map_names(feed: DataFrame, name_map: DataFrame) -> DataFrame:
    """Report teams under the names of the match source; an unmapped name stays.

    Both lookups use the same map. No broadcast is forced: Spark measures the map
    and broadcasts it below its threshold, else joins by shuffle and splits a hot
    team name (adaptive skew join).
    """
    home = name_map.select(F.col("fbref_team").alias("home_team_fb"), F.col("cfdm_team").alias("_home"))
    away = name_map.select(F.col("fbref_team").alias("away_team_fb"), F.col("cfdm_team").alias("_away"))
    joined = feed.join(home, "home_team_fb", "left").join(away, "away_team_fb", "left")
    named = joined.select(
        "match_url",
        "match_date_fb",
        F.coalesce("_home", "home_team_fb").alias("home_team_cf"),
        F.coalesce("_away", "away_team_fb").alias("away_team_cf"),
    )
    return named.withColumns(
        {"home_norm": F.lower(F.trim("home_team_cf")), "away_norm": F.lower(F.trim("away_team_cf"))}
    )


def match_candidates(mapped: DataFrame, matches: DataFrame, days: int = 1) -> DataFrame:
    """Matches of the same two teams on the report's day (priority 1) or up to ``days`` off (priority 2).

    The report side is repeated once per day of the band and joined on teams and
    day, so that a pair of teams with very many meetings is spread over its days
    and no two rows meet that are not candidates.
    """
    band = F.explode(F.sequence(F.lit(-days), F.lit(days))).alias("_shift")
    reports = mapped.select("*", band).withColumn("_day", F.date_add("match_date_fb", F.col("_shift")))
    right = matches.select(
        "cfmd_match_id",
        to_date("MatchDate").alias("_day"),
        "HomeTeam",
        "AwayTeam",
        "Division",
        F.coalesce(F.col("FTHome").cast("string"), F.lit("")).alias("FTHome"),
        F.coalesce(F.col("FTAway").cast("string"), F.lit("")).alias("FTAway"),
        F.lower(F.trim("HomeTeam")).alias("home_norm"),
        F.lower(F.trim("AwayTeam")).alias("away_norm"),
    )
    return reports.join(right, ["home_norm", "away_norm", "_day"]).select(
        "match_url",
        "match_date_fb",
        "home_team_cf",
        "away_team_cf",
        "cfmd_match_id",
        F.col("_day").alias("match_date_cf"),
        "HomeTeam",
        "AwayTeam",
        "Division",
        "FTHome",
        "FTAway",
        F.abs("_shift").alias("days_diff"),
        F.when(F.col("_shift") == 0, 1).otherwise(2).alias("priority_flag"),
    )


def best_candidates(candidates: DataFrame) -> DataFrame:
    """One row per report and match: best priority, then smallest distance.

    A plain minimum over a struct. Rows are dealt by report, once: what follows by report and match,
    or by report, needs no other shuffle of these wide rows.
    """
    keys = ["match_url", "cfmd_match_id"]
    ranked = ["priority_flag", "days_diff"]
    rest = [c for c in candidates.columns if c not in (*keys, *ranked)]
    best = candidates.repartition("match_url").groupBy(*keys).agg(F.min(F.struct(*ranked, *rest)).alias("best"))
    return best.select(*keys, "best.*").select(*candidates.columns)


def match_map(candidates: DataFrame) -> DataFrame:
    """Reports with exactly one candidate, and that candidate."""
    best = best_candidates(candidates)
    rest = [c for c in best.columns if c != "match_url"]
    counted = best.groupBy("match_url").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct(*rest)).alias("only"))
    return counted.where(F.col("k") == 1).select("match_url", "only.*").select(*candidates.columns)


def match_review(candidates: DataFrame) -> DataFrame:
    """Reports with several candidates: count, and the match ids by priority, then distance.

    The list holds the matches of one pair of teams on a few days, one per division.
    ``review_rows`` gives the same facts without lists.
    """
    best = best_candidates(candidates)
    entry = F.struct("priority_flag", "days_diff", "cfmd_match_id")
    grouped = best.groupBy("match_url").agg(
        F.min("match_date_fb").alias("match_date_fb"),
        F.min("home_team_cf").alias("home_team_cf"),
        F.min("away_team_cf").alias("away_team_cf"),
        F.count(F.lit(1)).alias("candidate_count"),
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["cfmd_match_id"]).alias("cfmd_candidates"),
        F.min("priority_flag").alias("best_priority"),
    )
    return grouped.where(F.col("candidate_count") > 1)


def in_review_order(review: DataFrame) -> DataFrame:
    """Most candidates first, then best priority."""
    return review.orderBy(F.desc("candidate_count"), F.asc("best_priority"), "match_url")


def review_rows(candidates: DataFrame) -> DataFrame:
    """One row per candidate of the reports that have several; rows without a report are left out.

    Counted over the rows as they were dealt by report, so that candidates are made once.
    """
    best = best_candidates(candidates).where(F.col("match_url").isNotNull())
    rest = [c for c in best.columns if c != "match_url"]
    counted = best.withColumn("candidate_count", F.count(F.lit(1)).over(Window.partitionBy("match_url")))
    return counted.where(F.col("candidate_count") > 1).select("match_url", *rest, "candidate_count")


def resolution_counts(feed: DataFrame, candidates: DataFrame) -> DataFrame:
    """Reports in all, and with no, one or several candidates; only what tells candidates apart is shuffled."""
    told = candidates.select("match_url", "cfmd_match_id", "priority_flag", "days_diff")
    best = best_candidates(told).groupBy("match_url").agg(F.count(F.lit(1)).alias("k"))
    urls = feed.select("match_url").distinct().join(best, "match_url", "left")
    return urls.agg(
        F.count(F.lit(1)).alias("reports"),
        F.count_if(F.col("k").isNull()).alias("none"),
        F.count_if(F.col("k") == 1).alias("resolved"),
        F.count_if(F.col("k") > 1).alias("several"),
    )
