"""From a raw match table to the lagged feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from touchline.operators import features, history, resolve
from touchline.session import materialise


def match_features(
    matches: DataFrame, divisions: tuple[str, ...] | None = resolve.BIG_FIVE, match_id: str = "cfmd_match_id"
) -> DataFrame:
    """Filter, keep, build, and attach history.

    The base features are written once between the two steps: history reads them
    for the rows, for the summaries of spans, and to join both.
    """
    chosen = resolve.filter_divisions(matches, divisions) if divisions else matches
    carry = () if match_id == "cfmd_match_id" else (match_id,)
    kept, _ = features.keep_columns(chosen, [*carry, *features.KEEP])
    base = materialise(features.build_features(kept, carry=carry))
    return history.lagged_features(base, match_id)
