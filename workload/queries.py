"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable
from functools import cache, reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.casts import to_date
from touchline.functions.chance import LABELS
from touchline.operators import (
    betting,
    evaluate,
    features,
    history,
    learn,
    names,
    players,
    prep,
    profile,
    resolve,
    split,
    streaks,
)
from touchline.plans import training
from touchline.session import drop_tables, ensure_checkpoint_dir, materialise, tune, write_table
from touchline.sources import commits, pages, ragged, records, tables
from touchline.streaming import history as arriving
from touchline.streaming import ingest, scoring
from workload import adapters as a

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# The given orders run from 1995 to 2001, so the date split is cut there.
TRAIN_UNTIL, VAL_UNTIL = dt.date(1998, 6, 30), dt.date(2000, 6, 30)
ROUND = 6


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    REGISTRY[fn.__name__] = run
    return fn


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places (and no negative zero), so that two engines can be compared."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, ROUND) + F.lit(0.0) for c in doubles}) if doubles else df


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the text matches, with their number."""
    return features.build_features(a.matches_text(spark, sf_dir), carry=("match_no",))


# ---- features and history


@query
def line_usage(spark, sf_dir):
    return a.line_usage(spark, sf_dir)


@query
def features_base(spark, sf_dir):
    return rounded(base(spark, sf_dir))


@query
def odds_implied(spark, sf_dir):
    m = features.typed_inputs(a.matches_text(spark, sf_dir), carry=("match_no",))
    return rounded(m.select("match_no", *features.odds_implied()))


@query
def label_summary(spark, sf_dir):
    return features.label_summary(features.build_features(a.matches_text(spark, sf_dir), unplayed="null"))


def history_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What history reads of the text matches."""
    columns = "match_no MatchDate MatchTime Division HomeTeam AwayTeam FTHome FTAway HomeElo AwayElo".split()
    return a.matches_text(spark, sf_dir).select(*columns)


VIEW = "match_no side match_date match_time_sort Division team opponent goals_for goals_against".split()


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team rows, written once with their text cast: history and streaks read them for the rows and for the summaries of spans."""
    return materialise(history.team_view(history_matches(spark, sf_dir), "match_no"))


def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.rolling(view(spark, sf_dir)).withColumnRenamed("match_id", "match_no")


@query
def team_view(spark, sf_dir):
    rows = view(spark, sf_dir).withColumnRenamed("match_id", "match_no")
    return rounded(rows.select(*VIEW, "elo", "points", "win", "draw", "loss"))


@query
def elo_change(spark, sf_dir):
    return rounded(rolling(spark, sf_dir).select("match_no", "side", "elo_change"))


@query
def rest_days(spark, sf_dir):
    return rolling(spark, sf_dir).select("match_no", "side", "rest_days")


@query
def rolling_form(spark, sf_dir):
    sums = "gf_last3 ga_last3 pts_last3 elo_trend3 gf_last5 ga_last5 pts_last5 elo_trend5".split()
    return rounded(rolling(spark, sf_dir).select("match_no", "side", *sums))


@query
def form_momentum(spark, sf_dir):
    return rolling(spark, sf_dir).select("match_no", "side", "form_momentum")


@query
def lagged_features(spark, sf_dir):
    m = base(spark, sf_dir).select("match_no", *"MatchDate MatchTime Division HomeTeam AwayTeam".split(),
                                   *"FTHome FTAway HomeElo AwayElo y_outcome".split())
    return rounded(history.lagged_features(materialise(m), "match_no"))


@query
def lagged_three_key(spark, sf_dir):
    m = base(spark, sf_dir).select("match_no", *"MatchDate MatchTime Division HomeTeam AwayTeam".split(),
                                   *"FTHome FTAway HomeElo AwayElo".split())
    return rounded(history.lagged_features(materialise(m), "match_no", attach="three_key"))


@query
def rolling_hot_team(spark, sf_dir):
    """Form and streaks where one team is at home in a third of all matches."""
    home = F.when(F.col("match_no") % 3 == 0, "HOT").otherwise(F.col("HomeTeam"))
    rows = materialise(history.team_view(history_matches(spark, sf_dir).withColumn("HomeTeam", home), "match_no"))
    form = history.rolling(rows).select("match_id", "side", "team", "gf_last5", "pts_last5", "elo_trend5", "rest_days", "form_momentum")
    runs = streaks.streaks(rows).select("match_id", "side", "win_streak_in", "noloss_streak_in")
    return rounded(form.join(runs, ["match_id", "side"]).withColumnRenamed("match_id", "match_no"))


@query
def stream_history(spark, sf_dir):
    """Matches that arrive year by year, each with the history of both teams from keyed state."""
    place, rows = work(spark), materialise(history_matches(spark, sf_dir))
    year = F.coalesce(F.year(to_date("MatchDate")), F.lit(9999))
    years = sorted(r[0] for r in rows.select(year).distinct().collect())  # one for each year of the calendar
    half = years[len(years) // 2]
    for n, part in enumerate((year <= half, (year > half) & (year < 9999), year == 9999)):
        tables.export_parquet(rows.where(part), f"{place}/in/{n}")
        # Every run but the first is a restart.
        stream = spark.readStream.schema(rows.schema).parquet(f"{place}/in/*")
        arriving.history_stream(stream, f"{place}/out", f"{place}/marks", "match_no").awaitTermination()
    out = spark.read.parquet(f"{place}/out")
    return rounded(out.select("match_no", *[f"{s}_{c}" for s in ("home", "away") for c in history.LAGGED]))


def streaks_documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaks.streaks(view(spark, sf_dir)).withColumnRenamed("match_id", "match_no")


REGISTRY["streaks"] = streaks_documented


@query
def streaks_as_written(spark, sf_dir):
    return streaks.streaks(view(spark, sf_dir), mode="as_written").withColumnRenamed("match_id", "match_no")


@query
def latest_matches(spark, sf_dir):
    rows = streaks.latest_matches(streaks.streaks(view(spark, sf_dir)))
    return rows.withColumnRenamed("match_id", "match_no")


def entry_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture records with some derived cells blanked or zero."""
    derived = "elo_diff elo_ratio form3_diff form5_diff qh qd qa qsum p_home p_draw p_away overround".split()
    given = "HomeElo AwayElo Form3Home Form3Away Form5Home Form5Away OddHome OddDraw OddAway MaxHome MaxDraw MaxAway"
    rows = base(spark, sf_dir).select(
        "match_no", *given.split(), *derived, "log_odds_away_vs_home", "shot_acc_home", "shot_acc_away", "shot_acc_diff"
    )
    no = F.col("match_no")
    blanks = {}
    for i, c in enumerate([*derived, "log_odds_away_vs_home", "shot_acc_diff"]):
        blanks[c] = F.when((no + i) % 3 == 0, F.lit(0.0)).when((no + i) % 3 == 1, F.lit(None)).otherwise(F.col(c))
    return rows.withColumns(blanks)


@query
def fill_derived(spark, sf_dir):
    return rounded(features.fill_derived(entry_form(spark, sf_dir)))


@query
def fill_derived_form(spark, sf_dir):
    return rounded(features.fill_derived(entry_form(spark, sf_dir), formula="form"))


# ---- sources


@query
def ragged_split(spark, sf_dir):
    out = split_lines(spark, sf_dir)
    lead = {f"c{i:02d}": F.get("fields", F.lit(i - 1)) for i in (1, 2, 6, 31)}
    return out.select("tag", F.col("width").cast("bigint").alias("width"),
                      *[c.alias(n) for n, c in lead.items()], *ragged.TAIL)


@query
def width_profile(spark, sf_dir):
    return ragged.width_profile(materialise(a.player_lines(spark, sf_dir)))


@query
def top_widths(spark, sf_dir):
    return ragged.top_widths(ragged.width_profile(materialise(a.player_lines(spark, sf_dir))))


@query
def page_titles(spark, sf_dir):
    return pages.page_titles(a.table(spark, sf_dir, "pages"))


@query
def page_links(spark, sf_dir):
    return pages.extract_links(a.table(spark, sf_dir, "pages"), pattern="^/", site="https://example.org")


@query
def report_titles(spark, sf_dir):
    return pages.page_titles(a.report_pages(spark, sf_dir))


@query
def report_links(spark, sf_dir):
    return pages.extract_links(a.report_pages(spark, sf_dir))


@query
def score_links(spark, sf_dir):
    return pages.extract_links(a.report_pages(spark, sf_dir), within=pages.SCORE_CELL)


@query
def page_tables(spark, sf_dir):
    rows = pages.extract_tables(a.report_pages(spark, sf_dir))
    return rows.select("url", "match_title", "table_no", "team_hint", "table_type", "row_no",
                       F.array_join("header", "|").alias("header"), F.array_join("cells", "|").alias("cells"))


def leagues(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = a.table(spark, sf_dir, "nation")
    return nation.select(F.col("n_name").alias("league_slug"), F.col("n_nationkey").alias("competition"))


@query
def season_grid(spark, sf_dir):
    return pages.season_grid(leagues(spark, sf_dir))


@query
def pending_units(spark, sf_dir):
    """League seasons without an order from that nation in that year."""
    units = pages.season_grid(leagues(spark, sf_dir), 1994, 2003)
    orders = a.table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("season_end"))
    customer = a.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = a.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                                     F.col("n_name").alias("league_slug"))
    done = orders.join(customer, "o_custkey").join(nation, "c_nationkey")
    return tables.pending_units(units, done, ["league_slug", "season_end"]).select("league_slug", "season_end", "season")


@query
def json_roundtrip(spark, sf_dir):
    m = base(spark, sf_dir).select("match_no", "match_date", "HomeElo", "OddHome", "OddDraw")
    bodies = records.to_payload(m, "body").select(F.concat(F.lit("["), "body", F.lit("]")).alias("body"))
    schema = T.StructType.fromDDL("match_no bigint, match_date string, HomeElo double, OddHome double, OddDraw double")
    back = records.from_records(bodies, schema)
    return rounded(back.withColumn("match_date", F.col("match_date").try_cast("date")))


@query
def payload_text(spark, sf_dir):
    m = base(spark, sf_dir).select("match_no", "match_date", "FTHome", "y_outcome")
    return records.to_payload(m)


# ---- projections and filters


@query
def filter_divisions(spark, sf_dir):
    m = a.matches(spark, sf_dir).select("match_no", "Division", "MatchDate", "HomeTeam", "AwayTeam")
    return resolve.filter_divisions(m, ("EUROPE", "ASIA"))


def with_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = a.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return orders.select("o_orderkey", "o_orderpriority", (F.year("o_orderdate") + 20).cast("string").alias("season_end"))


@query
def season_slices(spark, sf_dir):
    return split.season_slices(with_season(spark, sf_dir))


@query
def slice_counts(spark, sf_dir):
    return profile.first_groups(split.season_slices(with_season(spark, sf_dir)), ["o_orderpriority", "season_end"])


@query
def keep_columns(spark, sf_dir):
    return features.keep_columns(a.matches_text(spark, sf_dir), ["Division", "MatchDate", "Referee", "HomeTeam", "FTHome"])[0]


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tagged lines; the text itself is written first, as a scraped file would be."""
    return ragged.split_ragged(materialise(a.player_lines(spark, sf_dir)))


def unified_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players.harmonise_split(split_lines(spark, sf_dir))


@query
def harmonise_two_tables(spark, sf_dir):
    """The same rows by way of one table per layout."""
    rows = split_lines(spark, sf_dir)
    old = ragged.to_columns(rows, "summary_alt", ragged.OLD_WIDTH)
    new = ragged.to_columns(rows, "summary_neu", ragged.NEW_WIDTH)
    return rounded(players.harmonise_players(old, new))


@query
def harmonise_players(spark, sf_dir):
    return rounded(unified_players(spark, sf_dir))


@query
def team_aggregate(spark, sf_dir):
    return rounded(players.team_aggregate(unified_players(spark, sf_dir)))


@query
def enrich_titles(spark, sf_dir):
    unified = unified_players(spark, sf_dir)
    teams = players.team_aggregate(unified).select(*players.TEAM_KEYS, "min_sum", "gls_p90")
    return rounded(players.enrich_titles(teams, unified))


@query
def entity_names(spark, sf_dir):
    return names.entity_names(a.matches(spark, sf_dir), ["HomeTeam", "AwayTeam"])


@query
def leakage_drop(spark, sf_dir):
    return rounded(prep.drop_leakage(base(spark, sf_dir), "tuned"))


@query
def align_schema(spark, sf_dir):
    rows = base(spark, sf_dir).drop("MaxDraw", "shot_acc_diff")
    return rounded(prep.align_zero(rows, prep.FIXTURE_SCHEMA, carry=("match_no",)))


@query
def align_coerce(spark, sf_dir):
    rows = a.matches_text(spark, sf_dir).withColumn("match_date", F.regexp_replace("MatchDate", "-", ""))
    return rounded(prep.align_coerce(prep.coerce_float(rows), prep.FIXTURE_SCHEMA, carry=("match_no",)))


# ---- names and resolution


@query
def name_auto_map(spark, sf_dir):
    return names.name_auto_map(a.report_names(spark, sf_dir), a.match_names(spark, sf_dir))


@query
def name_auto_map_inspect(spark, sf_dir):
    return names.name_auto_map(a.report_names(spark, sf_dir), a.match_names(spark, sf_dir), "inspect")


@query
def name_norms_build(spark, sf_dir):
    return names.with_norm(a.report_names(spark, sf_dir), "build")


@query
def name_review(spark, sf_dir):
    return names.name_review(a.report_names(spark, sf_dir), a.match_names(spark, sf_dir))


@query
def name_candidates(spark, sf_dir):
    """The five nearest match names of each report name without a partner."""
    return names.name_candidates(a.report_names(spark, sf_dir), a.match_names(spark, sf_dir))


def final_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    auto = names.name_auto_map(a.report_names(spark, sf_dir), a.match_names(spark, sf_dir))
    return names.compile_map(auto, a.manual_map(spark, sf_dir))


@query
def compile_map(spark, sf_dir):
    return final_map(spark, sf_dir)


@query
def parse_titles(spark, sf_dir):
    return players.parse_titles(a.reports(spark, sf_dir))


def feed(reports: DataFrame) -> DataFrame:
    return resolve.report_feed(players.parse_titles(reports))


@query
def map_names(spark, sf_dir):
    return resolve.map_names(feed(a.reports(spark, sf_dir)), final_map(spark, sf_dir))


def both_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Matches and the reports of them, each written once, as two sources would be.

    Titles are read several times (both teams, the date, and the test that there are two teams).
    """
    columns = "match_no Division MatchDate home_key away_key HomeTeam AwayTeam FTHome FTAway".split()
    matches = materialise(a.matches(spark, sf_dir).select(*columns))
    return matches, materialise(a.titled(matches))


def candidates(spark: SparkSession, sf_dir: str, sources: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    matches, reports = sources or both_sources(spark, sf_dir)
    named = resolve.map_names(feed(reports), final_map(spark, sf_dir))
    return resolve.match_candidates(named, resolve.with_match_id(matches))


@query
def match_candidates(spark, sf_dir):
    return candidates(spark, sf_dir)


@query
def match_map(spark, sf_dir):
    return resolve.match_map(candidates(spark, sf_dir))


@query
def match_review(spark, sf_dir):
    # Written first, as a sort by ranges reads its rows twice.
    review = resolve.in_review_order(materialise(resolve.match_review(candidates(spark, sf_dir))))
    return review.withColumn("cfmd_candidates", F.array_join("cfmd_candidates", ";"))


@query
def review_rows(spark, sf_dir):
    return resolve.review_rows(candidates(spark, sf_dir)).select(
        "match_url", "candidate_count", "cfmd_match_id", "priority_flag", "days_diff"
    )


@query
def resolution_counts(spark, sf_dir):
    sources = both_sources(spark, sf_dir)
    return resolve.resolution_counts(feed(sources[1]), candidates(spark, sf_dir, sources))


# ---- counts and summaries


@query
def row_counts(spark, sf_dir):
    m = base(spark, sf_dir)
    return profile.row_counts(m, {"dated": F.col("match_date").isNotNull(), "home_wins": F.col("y_outcome") == "H"})


@query
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(a.matches(spark, sf_dir), ["Division", "HomeTeam", "MatchDate"])


@query
def duplicate_keys(spark, sf_dir):
    return players.duplicate_keys(a.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def duplicate_rows(spark, sf_dir):
    lines = a.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return players.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query
def class_share(spark, sf_dir):
    return rounded(prep.class_share(base(spark, sf_dir)))


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(base(spark, sf_dir), "FTHome")


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(base(spark, sf_dir))


NUMERIC = "FTHome FTAway HomeElo AwayElo elo_diff OddHome OddDraw qsum p_home shot_acc_home".split()


@query
def describe_numeric(spark, sf_dir):
    return rounded(profile.describe_numeric(materialise(base(spark, sf_dir).select(*NUMERIC)), NUMERIC))


@query
def corr_matrix(spark, sf_dir):
    return rounded(profile.corr_matrix(base(spark, sf_dir), NUMERIC))


@query
def goal_totals(spark, sf_dir):
    return profile.totals(base(spark, sf_dir), ["FTHome", "FTAway"])


@query
def overview(spark, sf_dir):
    return profile.overview(a.matches(spark, sf_dir).select("match_no", "Division", "MatchDate", "HomeElo", "AwayElo"))


@query
def union_loose(spark, sf_dir):
    m = a.matches(spark, sf_dir)
    home = m.select("match_no", F.col("HomeTeam").alias("team"), "FTHome")
    away = m.select("match_no", F.col("AwayTeam").alias("team"), "FTAway")
    return players.union_loose([home, away])


# ---- splits and preparation


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_by_date(base(spark, sf_dir), "match_date", TRAIN_UNTIL, VAL_UNTIL)


@query
def date_split(spark, sf_dir):
    return dated(spark, sf_dir).select("match_no", "match_date", "split")


@query
def fraction_split(spark, sf_dir):
    rows = base(spark, sf_dir).select("match_no", "match_date")
    return split.split_by_fraction(materialise(rows))


@query
def prep_matrix(spark, sf_dir):
    rows = dated(spark, sf_dir).select("match_no", "split", *NUMERIC)
    return rounded(prep.fill_zero(rows, NUMERIC))


@query
def missing_flags(spark, sf_dir):
    m = base(spark, sf_dir).select("match_no", *"MatchDate MatchTime Division HomeTeam AwayTeam".split(),
                                   *"FTHome FTAway HomeElo AwayElo".split())
    flagged = prep.missing_flags(history.lagged_features(materialise(m), "match_no"))
    return flagged.select("match_no", *[f"{c}__is_na" for c in prep.MAY_BE_MISSING])


IMPUTED = "HomeElo elo_diff OddHome OddDraw qsum shot_acc_home".split()


@query
def median_impute(spark, sf_dir):
    rows = materialise(dated(spark, sf_dir).where("split is not null").select("match_no", "split", *IMPUTED))
    return rounded(prep.median_impute(rows, IMPUTED, source="train"))


@query
def median_impute_own(spark, sf_dir):
    rows = materialise(dated(spark, sf_dir).where("split is not null").select("match_no", "split", *IMPUTED))
    return rounded(prep.median_impute(rows, IMPUTED, source="own"))


# ---- evaluation and betting


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_by_date(a.fixtures(spark, sf_dir), "MatchDate", TRAIN_UNTIL, VAL_UNTIL)


@query
def eval_accuracy(spark, sf_dir):
    return rounded(evaluate.accuracy(scored(spark, sf_dir), ("split",)))


@query
def eval_log_loss(spark, sf_dir):
    return rounded(evaluate.log_loss(scored(spark, sf_dir), ("split",)))


@query
def class_report(spark, sf_dir):
    return rounded(evaluate.class_report(scored(spark, sf_dir)))


@query
def confusion(spark, sf_dir):
    return evaluate.confusion(scored(spark, sf_dir))


@query
def reliability(spark, sf_dir):
    rows = evaluate.reliability(materialise(scored(spark, sf_dir)))
    return rounded(rows.withColumn("bin", F.col("bin").cast("bigint")))


def with_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled features whose normalised shares have gaps the raw ones can fill."""
    gap = F.col("match_no") % 4 == 0
    return dated(spark, sf_dir).withColumn("p_draw", F.when(~gap, F.col("p_draw")))


@query
def odds_benchmark(spark, sf_dir):
    rows = dated(spark, sf_dir).drop("p_home", "p_draw", "p_away")
    return rounded(evaluate.odds_benchmark(rows, mode="column"))


@query
def odds_benchmark_row(spark, sf_dir):
    return rounded(evaluate.odds_benchmark(with_odds(spark, sf_dir), mode="row"))


def model_and_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = a.fixtures(spark, sf_dir)
    shares = {"qh": "odd_H", "qd": "odd_D", "qa": "odd_A"}
    priced = f.withColumns({q: F.try_divide(F.lit(1.0), F.col(o)) for q, o in shares.items()})
    return evaluate.odds_probabilities(priced)


@query
def blend_losses(spark, sf_dir):
    return rounded(evaluate.blend_losses(model_and_market(spark, sf_dir)))


@query
def blend_search(spark, sf_dir):
    return rounded(evaluate.blend_search(model_and_market(spark, sf_dir)))


@query
def score_edges(spark, sf_dir):
    return rounded(betting.edges_normalised(a.fixtures(spark, sf_dir)))


@query
def score_kelly(spark, sf_dir):
    rows = betting.edges_normalised(a.fixtures(spark, sf_dir), kelly=True, threshold=0.1)
    return rounded(rows.select("match_no", "best_pick", "kelly_frac", "stake_suggestion", "bet_recommendation"))


@query
def score_edges_raw(spark, sf_dir):
    rows = a.fixtures(spark, sf_dir).withColumn("odd_D", F.when(F.col("match_no") % 23 == 0, F.lit(0.0)).otherwise(F.col("odd_D")))
    named = {"H": "odd_H", "D": "odd_D", "A": "odd_A"}
    out = betting.edges_raw(rows, odds=named, threshold=0.05, kelly=True)
    sides = ("home", "draw", "away")
    return rounded(out.select("match_no", *[f"{m}_{s}" for m in ("proba", "edge", "kelly") for s in sides]))


# ---- models: trained on the whole table, with history and the library's own settings, when the query is built.
# Learned numbers have no SQL; the queries give counts and what must hold of every score, taken from the scores.


# Order lines (up to a half as many matches) whose history is shuffled at a time.
SLICE_LINES = 20_000_000


@cache
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = math.ceil(max(1, a.table(spark, sf_dir, "lineitem").count()) / SLICE_LINES)
    placed = lambda rows: split.split_by_date(rows, "match_date", TRAIN_UNTIL, VAL_UNTIL).where("split is not null")
    if slices == 1:
        matches = materialise(base(spark, sf_dir), "zstd")
        out = materialise(placed(history.lagged_features(matches, "match_no")), "zstd")
    else:
        matches = write_table(base(spark, sf_dir).withColumn("_slice", history.slice_of(F.col("match_no"), slices)), ["_slice"], codec="zstd")
        out = history.sliced_lagged_features(matches, slices, "match_no", finish=placed)
    drop_tables(matches)  # not read again
    return out


@cache
def boosted_model(spark: SparkSession, sf_dir: str) -> training.Boosted:
    return training.train_boosted(
        training_rows(spark, sf_dir), exclude=("match_no",), calibration="sigmoid", weights=learn.BOOSTED_WEIGHTS
    )


@cache
def isotonic_model(spark: SparkSession, sf_dir: str) -> training.Boosted:
    return training.recalibrated(boosted_model(spark, sf_dir), "isotonic")


def chances_ok() -> Column:
    """Chances between 0 and 1 that add up to 1."""
    chances = [F.col(c) for c in evaluate.PROBABILITIES]
    whole = F.abs(reduce(lambda x, y: x + y, chances) - 1.0) < 1e-6
    return F.coalesce(reduce(lambda x, y: x & y, [c.between(0.0, 1.0) for c in chances]) & whole, F.lit(False))


def model_rows(name: str, scored: DataFrame, learned: str | None) -> DataFrame:
    """Rows of each split, whether all chances are sound, and whether training rows were learned.

    ``learned``  "balanced": with classes balanced, the mean loss on training rows is below that of equal chances;
                 "shares": the loss on training rows is below that of the shares of the classes;
                 None: not asked of a calibrated model, whose maps are fitted on other rows.
    """
    # Written once: hundreds of trees a row are not walked again for the second figure.
    labelled = materialise(scored.where(F.col(prep.LABEL).isNotNull()).select("split", prep.LABEL, *evaluate.PROBABILITIES))
    counts = labelled.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(chances_ok()).alias("chances_ok"))
    by_class = evaluate.log_loss(labelled.where("split = 'train'"), (prep.LABEL,)).select("log_loss", "n_rows")
    rows = F.sum("n_rows")
    plain = F.sum(F.col("log_loss") * F.col("n_rows")) / rows
    # Entropy of the class shares, from the counts: ln(n) - sum(n_c ln(n_c)) / n.
    shares = F.ln(rows) - F.sum(F.col("n_rows") * F.ln("n_rows")) / rows
    claim = {"balanced": F.avg("log_loss") < math.log(3), "shares": plain < shares}
    fits = by_class.agg(claim[learned].alias("fits_training")).scalar() if learned else F.lit(None).cast("boolean")
    return counts.select(F.lit(name).alias("model"), "split", "n_rows", "chances_ok", fits.alias("fits_training"))


@query
def baseline_scores(spark, sf_dir):
    fitted = training.train_baselines(training_rows(spark, sf_dir), exclude=("match_no",))
    models = {"logistic": fitted.logistic, "forest": fitted.forest}
    return reduce(DataFrame.unionByName, [model_rows(n, learn.score(fitted.rows, m), "balanced") for n, m in models.items()])


@query
def boosted_scores(spark, sf_dir):
    """The boosted model, and both of its calibrations; isotonic maps must not fall."""
    boosted, isotonic = boosted_model(spark, sf_dir), isotonic_model(spark, sf_dir).calibrated
    out = [
        model_rows("boosted", boosted.model.score(boosted.rows), "shares").withColumn("rising", F.lit(None).cast("boolean")),
        model_rows("sigmoid", boosted.calibrated.score(boosted.rows), None).withColumn("rising", F.lit(None).cast("boolean")),
        model_rows("isotonic", isotonic.score(boosted.rows), None).withColumn("rising", F.lit(learn.rising(isotonic))),
    ]
    return reduce(DataFrame.unionByName, out)


@query
def search_scores(spark, sf_dir):
    """A search by halving: how many trials ended, that all lie in their ranges, and that none was better than the first."""
    space = {"step": (0.05, 0.15), "depth": (2, 3), "min_leaf": (18, 80), "rounds": (4, 8), "sample": (0.5, 1.0)}
    train, val = (training_rows(spark, sf_dir).where(F.col("split") == s) for s in ("train", "val"))
    train, val = (materialise(prep.fill_zero(rows, list(NUMERIC)).select(prep.LABEL, *NUMERIC)) for rows in (train, val))
    done = learn.search_trials(train, val, list(NUMERIC), trials=4, space=space, halvings=1)
    told = spark.createDataFrame([(*(float(getattr(t.params, k)) for k in space), t.loss) for t in done], [*space, "loss"])
    inside = reduce(lambda x, y: x & y, [F.col(k).between(*map(float, bounds)) for k, bounds in space.items()])
    return told.agg(
        F.count(F.lit(1)).alias("trials"), F.bool_and(inside).alias("in_range"),
        (F.min("loss") == F.lit(done[0].loss)).alias("best_ok"), F.bool_and(F.col("loss") > 0).alias("loss_ok"),
    )


@query
def categorical_scores(spark, sf_dir):
    """A model with the division as category, stored and loaded; fixtures of a division it has not seen, or of none."""
    params = learn.BoostedParams(rounds=10, depth=3)
    rows, place = training_rows(spark, sf_dir), work(spark)
    result = training.train_boosted(rows, exclude=("match_no",), params=params, categorical=("Division",))
    learn.save(result.model, prep.FIXTURE_SCHEMA, spark, f"{place}/model")
    model, schema = learn.load(spark, f"{place}/model")
    no = F.col("match_no")
    division = F.when(no % 5 == 0, "ATLANTIS").when(no % 5 == 1, F.lit(None)).otherwise(F.col("Division"))
    fixtures = base(spark, sf_dir).select("match_no", division.alias("Division"), *prep.FIXTURE_COLUMNS)
    out = training.score_fixtures(fixtures, model, schema)
    known = F.coalesce(F.col("Division").isin(model.categories["Division"]), F.lit(False)).alias("known")
    return out.groupBy("Division", known).agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(chances_ok()).alias("chances_ok"))


@query
def blended_scores(spark, sf_dir):
    """The blend chosen on validation rows: its weight, and that no other weight was better there."""
    result = isotonic_model(spark, sf_dir)
    val = result.scored.where("split = 'val'")
    chosen = training.blend_with_market(result).select("alpha", F.col("log_loss").alias("test_loss"))
    least = evaluate.blend_losses(val).agg(F.min_by("alpha", F.struct("log_loss", "alpha")).alias("best"), F.count(F.lit(1)).alias("weights"))
    return chosen.crossJoin(F.broadcast(least)).select(  # one row each
        "weights",
        F.col("alpha").between(0.0, 1.0).alias("alpha_ok"),
        (F.abs(F.col("alpha") - F.col("best")) < 1e-9).alias("best_ok"),
        (F.col("test_loss") > 0).alias("loss_ok"),
    )


def as_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).select("match_no", *prep.FIXTURE_COLUMNS)


@query
def fixture_scores(spark, sf_dir):
    """Every match scored as a fixture: raw edges; a stake only above the threshold and with a price."""
    model = isotonic_model(spark, sf_dir).calibrated
    out = training.score_fixtures(as_fixtures(spark, sf_dir), model, prep.FIXTURE_SCHEMA, kelly=True, threshold=0.05)
    sides = {"OddHome": "home", "OddDraw": "draw", "OddAway": "away"}
    fair = [(F.col(f"kelly_{n}") == 0) | ((F.col(o) > 0) & (F.col(f"edge_{n}") > 0.05)) for o, n in sides.items()]
    stakes_ok = F.coalesce(reduce(lambda x, y: x & y, fair), F.lit(False)).alias("stakes_ok")
    return rounded(out.select("match_no", *sides, chances_ok().alias("chances_ok"), stakes_ok))


@query
def fixture_picks(spark, sf_dir):
    """Every match scored as a fixture: edges without margin, best pick, and whether to bet on it."""
    model = isotonic_model(spark, sf_dir).calibrated
    out = training.score_fixtures(
        as_fixtures(spark, sf_dir), model, prep.FIXTURE_SCHEMA, kelly=True, threshold=0.05, edges="normalised"
    )
    edges = [F.coalesce(F.col(f"edge_{c}"), F.lit(float("-inf"))) for c in LABELS]
    best_ok = F.col("best_edge").isNull() | (F.col("best_edge") >= F.greatest(*edges) - 1e-12)
    bet_ok = F.col("bet_recommendation") == F.when(F.col("best_edge") >= 0.05, F.col("best_pick")).otherwise("")
    return out.select("match_no", chances_ok().alias("chances_ok"), best_ok.alias("best_ok"), bet_ok.alias("bet_ok"))


@query
def stored_report(spark, sf_dir):
    """The report of a stored model: saved, loaded, scored, written out and read back."""
    result, place = isotonic_model(spark, sf_dir), work(spark)
    learn.save(result.calibrated, prep.FIXTURE_SCHEMA, spark, f"{place}/model")
    loaded, _ = learn.load(spark, f"{place}/model")
    scored = loaded.score(result.rows.where("split = 'test'"))
    tables.export_csv(training.report(scored)["confusion"], f"{place}/confusion")
    back = tables.scan(spark, f"{place}/confusion")
    n_rows = reduce(lambda x, y: x + y, [F.col(f"pred_{c}").cast("long") for c in LABELS])
    return back.select(F.substring("label", 6, 1).alias("actual"), n_rows.alias("n_rows"))


@query
def stream_scores(spark, sf_dir):
    """Matches scored as they arrive in a folder."""
    place = work(spark)
    rows = as_fixtures(spark, sf_dir)
    tables.export_parquet(rows, f"{place}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{place}/in")
    model = isotonic_model(spark, sf_dir).calibrated
    scoring.score_stream(stream, model, prep.FIXTURE_SCHEMA, f"{place}/out", f"{place}/marks").awaitTermination()
    return spark.read.parquet(f"{place}/out").select("match_no", chances_ok().alias("chances_ok"))


# ---- sources and sinks: a given table written to a work folder and read back


def work(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/work-{uuid.uuid4().hex}"


@query
def csv_lenient(spark, sf_dir):
    """Lines of two to four fields, read as three columns of text."""
    key, place = F.col("c_custkey"), work(spark)
    short = F.concat_ws(",", key, F.lit('"a ""b"", c"'))
    line = F.when(key % 7 == 0, F.concat(short, F.lit(",x,y"))).when(key % 5 == 0, short).otherwise(F.concat_ws(",", short, "c_mktsegment"))
    a.table(spark, sf_dir, "customer").select(line).write.text(place)
    return tables.scan_lenient(spark, place, ["key", "name", "segment"], header=False)


@query
def csv_quoted_breaks(spark, sf_dir):
    """Rows with line breaks, quotes and commas in quoted fields, read by splits."""
    key, place = F.col("c_custkey"), work(spark)
    free = F.when(key % 3 == 0, F.concat(F.lit('of "'), "c_name", F.lit('",\n\nline two'))).otherwise(F.col("c_name"))
    rows = a.table(spark, sf_dir, "customer").select("c_custkey", free.alias("note"), "c_mktsegment")
    tables.export_csv(rows, place)
    return tables.scan(spark, place)


@query
def reject_counts(spark, sf_dir):
    """Rejected rows by reason: as the scan observed them, and as the side table lists them."""
    key, place = F.col("c_custkey"), work(spark)
    line = F.when(key % 7 == 0, F.concat_ws(",", key, "c_name", F.lit("x,y"))).when(key % 5 == 0, key.cast("string"))
    a.table(spark, sf_dir, "customer").select(F.coalesce(line, F.concat_ws(",", key, "c_name")).alias("value")).write.text(place)
    wrong = F.when(F.col("o_orderkey") % 9 == 0, F.lit("n/a")).when(F.col("o_orderkey") % 9 != 1, F.col("season_end"))
    found = {
        "csv": tables.scan_screened(spark, place, ["key", "name"], header=False),
        "lines": ragged.screened_lines(a.player_lines(spark, sf_dir)),
        "seasons": split.screened_slices(with_season(spark, sf_dir).withColumn("season_end", wrong)),
    }
    out = []
    for name, screened in found.items():
        seen = spark.createDataFrame(list(screened.counts.items()), "reason string, n_rows bigint")
        listed = screened.rejects.groupBy(F.col("reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("listed"))
        kept = screened.kept.agg(F.count(F.lit(1))).scalar()
        told = seen.join(listed, "reason", "left").select(F.lit(name).alias("source"), "reason", "n_rows", F.coalesce("listed", F.lit(0)).alias("n_listed"))
        out.append(told.withColumn("n_kept", kept))
    return reduce(DataFrame.unionByName, out)


@query
def csv_plain(spark, sf_dir):
    place = work(spark)
    rows = a.table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("c_name"))
    tables.export_csv(rows, place)
    return tables.scan(spark, tables.first_existing(spark, [f"{place}-none", place]))


@query
def csv_typed(spark, sf_dir):
    place = work(spark)
    rows = a.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    tables.export_csv(rows, place)
    found = tables.columns_of(tables.scan_typed(spark, place))
    typed = tables.scan_typed(spark, place, rows.schema)
    return typed.withColumn("inferred", F.lit(",".join(found.values())))


@query
def parquet_parts(spark, sf_dir):
    """Orders written by status; a filter on the status reads one folder."""
    place = work(spark)
    tables.export_parquet(a.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), place, ["o_orderstatus"])
    return spark.read.parquet(place).where("o_orderstatus <> 'P'")


@query
def ingest_files(spark, sf_dir):
    """Files of suppliers taken in as parts of nations, one of them delivered twice."""
    place = work(spark)
    rows = a.table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey")
    for part in range(2):
        tables.export_csv(rows.where(F.col("s_suppkey") % 2 == part), f"{place}/in/{part}")
        stream = ingest.read_stream(spark, f"{place}/in/*", rows.schema)
        for marks in ("a", f"b{part}"):  # new marks: all files come again
            ingest.ingest(stream, f"{place}/out", f"{place}/done", f"{place}/{marks}", ["s_nationkey"]).awaitTermination()
    return spark.read.parquet(f"{place}/out").select("s_suppkey", F.col("s_nationkey").cast("int").alias("s_nationkey"))


@query
def ingest_commits(spark, sf_dir):
    """Files of suppliers committed by nation, one delivered twice; nations that were asked for and their state."""
    place = work(spark)
    rows = a.table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey")
    table = commits.CommitTable(spark, f"{place}/table", ("s_nationkey",), rows.schema)
    kept = rows.where("s_nationkey % 5 <> 0")
    for part in range(2):
        tables.export_csv(kept.where(F.col("s_suppkey") % 2 == part), f"{place}/in/{part}")
        stream = ingest.read_stream(spark, f"{place}/in/*", rows.schema)
        for marks in ("a", f"b{part}"):  # new marks: all files come again
            ingest.ingest_commits(stream, table, f"{place}/{marks}").awaitTermination()
    nations = a.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast(rows.schema["s_nationkey"].dataType).alias("s_nationkey"))
    table.fail(nations.where("s_nationkey % 10 = 0"), "no answer")
    table.append(rows.limit(0), "late", asked=nations.where("s_nationkey % 10 = 5"))
    read = table.read().groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_read"), F.sum("s_suppkey").alias("keys"))
    asked = table.pending(nations).select("s_nationkey", F.lit(True).alias("asked_again"))
    out = table.states().join(read, "s_nationkey", "left").join(asked, "s_nationkey", "left")
    return out.select(F.col("s_nationkey").cast("int").alias("s_nationkey"), "status", "n_rows", "n_read", "keys", "asked_again")


# ---- labels and column lists


@query
def required_columns(spark, sf_dir):
    checked = features.require(a.matches_text(spark, sf_dir))
    return checked.select("match_no", *features.REQUIRED)


@query
def numeric_inputs(spark, sf_dir):
    """Filled cells of every numeric column that each list of leaking columns leaves."""
    rows = base(spark, sf_dir)
    out = []
    for mode in ("baseline", "boosted"):
        numeric, _ = prep.split_types(prep.drop_leakage(rows, mode))
        counts = rows.agg(*[F.count(c).alias(c) for c in numeric])
        out.append(counts.unpivot([], numeric, "column", "n_rows").select(F.lit(mode).alias("mode"), "column", "n_rows"))
    return out[0].unionByName(out[1])


@query
def label_numbers(spark, sf_dir):
    weight = F.create_map(*[F.lit(x) for c, w in learn.BOOSTED_WEIGHTS.items() for x in (c, w)])
    rows = learn.labelled(base(spark, sf_dir))
    return rows.select("match_no", "label", weight[F.col(prep.LABEL)].alias("weight"))


@query
def result_labels(spark, sf_dir):
    """Outcomes of a table that holds results but no goals."""
    rows = a.matches_text(spark, sf_dir).drop("FTHome", "FTAway")
    return features.build_features(rows, carry=("match_no",)).select("match_no", "FTResult", "y_outcome", "y_home_win")
