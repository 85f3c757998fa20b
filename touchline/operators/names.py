"""Team names of two sources: collecting, matching, and the map between them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.text import normalise_name


def entity_names(df: DataFrame, columns: list[str], keep_null: bool = False) -> DataFrame:
    """Distinct team names found in any of several columns, in one pass."""
    names = df.select(F.explode(F.array(*columns)).alias("team_name")).distinct()
    return names if keep_null else names.where(F.col("team_name").isNotNull())


def with_norm(names: DataFrame, variant: str = "clean") -> DataFrame:
    return names.select("team_name", normalise_name("team_name", variant).alias("norm")).distinct()


def name_auto_map(left: DataFrame, right: DataFrame, variant: str = "clean") -> DataFrame:
    """Pairs of names with the same comparison key: fbref_team, cfdm_team, norm.

    Names of which nothing is left as a key ("FC") would all pair with each other; they pair with none.
    """
    a = with_norm(left, variant).select(F.col("team_name").alias("fbref_team"), "norm")
    b = with_norm(right, variant).select(F.col("team_name").alias("cfdm_team"), "norm")
    return a.where("norm <> ''").join(b, "norm").select("fbref_team", "cfdm_team", "norm")


# A candidate is at most this share of a name's letters away from it.
EDIT_SHARE = 0.4
# Right names and left names that one task compares at a time.
SECTION_NAMES, BLOCK_NAMES = 32_768, 2_048


def _prefixes(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """The prefixes of sorted ``texts`` by length: (letter, place of the prefix before it); and each text's length and prefix."""
    length = np.array([len(t) for t in texts], np.int64)
    letters = np.zeros((len(texts), int(length.max(initial=0))), np.uint32)
    for i, t in enumerate(texts):
        letters[i, : len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    place, ends, levels = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), []
    for k in range(letters.shape[1]):
        there = np.flatnonzero(length > k)
        # A prefix starts where its letter or the prefix before it differs from the text above.
        first = np.ones(len(there), bool)
        first[1:] = (np.diff(place[there]) != 0) | (letters[there[1:], k] != letters[there[:-1], k])
        levels.append((letters[there[first], k], place[there[first]]))
        place[there] = np.cumsum(first) - 1
        ends[there] = place[there]
    return levels, length, ends


def _edits_within(text: str, most: int, levels: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Edit distance from ``text`` to every prefix of ``_prefixes``, by length; ``most`` + 1 stands for more."""
    own = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    steps = np.arange(len(own) + 1)
    rows, alive, out = steps[None, :], np.zeros(1, np.int64), [np.array([min(len(own), most + 1)])]
    for letter, before in levels:
        # Only prefixes of which the one before is still within reach are gone on with.
        at = np.full(len(out[-1]), -1)
        at[alive] = np.arange(len(alive))
        mine = np.flatnonzero(at[before] >= 0)
        above = rows[at[before[mine]]]
        row = np.empty_like(above)
        row[:, 0] = above[:, 0] + 1
        row[:, 1:] = np.minimum(above[:, 1:] + 1, above[:, :-1] + (letter[mine, None] != own))
        row = np.minimum.accumulate(row - steps, axis=1) + steps
        told = np.full(len(letter), most + 1)
        told[mine] = np.minimum(row[:, -1], most + 1)
        near = row.min(axis=1) <= most
        rows, alive = row[near], mine[near]
        out.append(told)
    return out


def _nearest(left: pa.Table, right: pa.Table, n: int) -> pa.Table:
    """(norm, cfdm_team, edits): for each left key its ``n`` nearest right names, by edits, then name."""
    pairs = sorted(zip(right["other"].to_pylist(), right["cfdm_team"].to_pylist(), strict=True))
    teams = [team for _, team in pairs]
    by_name = np.argsort(np.array(sorted(range(len(teams)), key=teams.__getitem__), np.int64))
    levels, length, ends = _prefixes([other for other, _ in pairs])
    norms, found, edits = [], [], []
    for norm, most in zip(left["norm"].to_pylist(), left["most"].to_pylist(), strict=True):
        told = _edits_within(norm, most, levels)
        starts = np.cumsum([0] + [len(t) for t in told[:-1]])
        far = np.concatenate(told)[starts[length] + ends]
        near = np.flatnonzero(far <= most)
        near = near[np.lexsort((by_name[near], far[near]))][:n]
        norms += [norm] * len(near)
        found += [teams[i] for i in near]
        edits += far[near].tolist()
    return pa.table({"norm": pa.array(norms, pa.string()), "cfdm_team": pa.array(found, pa.string()), "edits": pa.array(edits, pa.int32())})


def name_candidates(left: DataFrame, right: DataFrame, n: int = 5, variant: str = "clean", share: float = EDIT_SHARE) -> DataFrame:
    """The ``n`` nearest names of the right source for each name of the left one that found no partner.

    fbref_team, norm, rank, cfdm_team, edits: by edit distance of the comparison keys, then by name; only
    names within ``share`` of the left key's length. Names without a key have no candidates. Right names are
    dealt to sections by hash and left ones to blocks; a task compares a block with a section along the common
    prefixes of the section's names, leaves a prefix that is out of reach, and passes on ``n`` names for each left
    one. Starts a job that counts both sides.
    """
    if not 0 < share < 0.5:
        raise ValueError("share must lie between 0 and 0.5")
    a = with_norm(left, variant).where(F.col("team_name").isNotNull() & (F.col("norm") != ""))
    b = with_norm(right, variant).where(F.col("team_name").isNotNull() & (F.col("norm") != ""))
    b = b.select(F.col("team_name").alias("cfdm_team"), F.col("norm").alias("other"))
    lonely = a.join(b.select(F.col("other").alias("norm")).distinct(), "norm", "left_anti")
    asked = lonely.select("norm").distinct().withColumn("most", F.floor(F.length("norm") * F.lit(share)).cast("int"))
    sections, blocks = (max(1, math.ceil(x.count() / size)) for x, size in ((b, SECTION_NAMES), (asked, BLOCK_NAMES)))

    def dealt(rows: DataFrame, mine: str, parts: int, other: str, others: int) -> DataFrame:
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(parts)).cast("int").alias(mine)
        return rows.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    pairs = dealt(asked, "block", blocks, "section", sections).groupBy("block", "section")
    pairs = pairs.cogroup(dealt(b, "section", sections, "block", blocks).groupBy("block", "section"))
    met = pairs.applyInArrow(lambda x, y: _nearest(x, y, n), "norm string, cfdm_team string, edits int")
    best = Window.partitionBy("norm").orderBy("edits", "cfdm_team")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    told = lonely.select(F.col("team_name").alias("fbref_team"), "norm")
    return told.join(ranked.select("norm", "rank", "cfdm_team", "edits"), "norm").select("fbref_team", "norm", "rank", "cfdm_team", "edits")


def name_review(left: DataFrame, right: DataFrame, variant: str = "clean") -> DataFrame:
    """Names of the left source that found no partner, with the number of candidates.

    All names of the right source are candidates, ``with_norm(right)``, and are not
    repeated on each row; ``name_candidates`` gives the nearest ones. A missing name on the left never qualifies.
    """
    a = with_norm(left, variant)
    norms = with_norm(right, variant).select("norm").distinct()
    lonely = a.where(F.col("team_name").isNotNull()).join(norms, "norm", "left_anti")
    size = right.select("team_name").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return lonely.select(F.col("team_name").alias("fbref_team"), "norm", size.alias("candidate_count"))


def compile_map(auto: DataFrame, manual: DataFrame) -> DataFrame:
    """Automatic and manual pairs in one map, a manual pair beating an automatic one.

    Within one source the largest partner wins, so that the outcome does not hang
    on the order of rows. Incomplete pairs and repeats are dropped; blanks around
    the column names of the manual table are accepted.
    """
    trimmed = manual.toDF(*[c.strip() for c in manual.columns])
    ranked = auto.select("fbref_team", "cfdm_team", F.lit(0).alias("rank")).unionByName(
        trimmed.select("fbref_team", "cfdm_team", F.lit(1).alias("rank"))
    )
    pairs = ranked.dropna(subset=["fbref_team", "cfdm_team"])
    best = F.max_by("cfdm_team", F.struct("rank", "cfdm_team"))
    return pairs.groupBy("fbref_team").agg(best.alias("cfdm_team"))


def compile_map_ordered(auto: DataFrame, manual: DataFrame, ordinal: str) -> DataFrame:
    """``compile_map`` for tables that carry their row order: the last row of a source wins."""
    ranked = auto.select("fbref_team", "cfdm_team", ordinal, F.lit(0).alias("rank")).unionByName(
        manual.select("fbref_team", "cfdm_team", ordinal, F.lit(1).alias("rank"))
    )
    pairs = ranked.dropna(subset=["fbref_team", "cfdm_team"])
    # A repeated pair keeps its first place, as dropping repeats before the merge does.
    first = pairs.groupBy("fbref_team", "cfdm_team", "rank").agg(F.min(ordinal).alias("place"))
    best = F.max_by("cfdm_team", F.struct("rank", "place"))
    return first.groupBy("fbref_team").agg(best.alias("cfdm_team"))
