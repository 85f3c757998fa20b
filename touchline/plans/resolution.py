"""From ragged player lines and a match table to the match map."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from touchline.operators import names, players, resolve
from touchline.session import materialise
from touchline.sources import ragged


@dataclass(frozen=True)
class Resolution:
    team_rows: DataFrame
    name_map: DataFrame
    candidates: DataFrame
    match_map: DataFrame
    review: DataFrame
    counts: DataFrame


def resolve_matches(lines: DataFrame, matches: DataFrame, manual: DataFrame, variant: str = "clean") -> Resolution:
    """Team rows per report, the name map, and which match each report belongs to."""
    unified = players.harmonise_split(ragged.split_ragged(lines))
    team_rows = materialise(players.enrich_titles(players.team_aggregate(unified), unified))
    # A report appears once per team row; one copy is enough to find its match.
    feed = resolve.report_feed(team_rows).distinct()
    report_names = names.entity_names(team_rows, ["home_team_fb", "away_team_fb"])
    match_names = names.entity_names(matches, ["HomeTeam", "AwayTeam"])
    name_map = names.compile_map(names.name_auto_map(report_names, match_names, variant), manual)
    mapped = resolve.map_names(feed, name_map)
    candidates = materialise(resolve.match_candidates(mapped, resolve.with_match_id(matches)))
    return Resolution(
        team_rows,
        name_map,
        candidates,
        resolve.match_map(candidates),
        resolve.match_review(candidates),
        resolve.resolution_counts(feed, candidates),
    )
