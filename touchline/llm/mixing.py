"""Mixing sources to target weights.

Words are summed per source. Sources in order share a multiple of all words by their weights; a target
stops at ``most`` times the words its source has, and what is left over is shared again among the others.
The repetition rate of a source is its target over its words; each of its documents is taken
floor(rate) times, and once more by a Bernoulli draw with the fraction as its chance. The draw is a hash
of the document and a seed, so that a rerun draws the same.

Only DataFrame functions are used. Sources are folded before each shuffle and stay a table: the driver
sees two sums a round of sharing.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.running import running
from touchline.session import materialise

from .tables import col, fresh

#: A word is a run of other characters than these.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST = 2
SEED = 11
#: Bits of a hash that make a draw; a double holds them exactly.
DRAW_BITS = 52


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weighted(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` with ``weight``: the weights in turn, by code point of ``source``, null last."""
    placed = running(sources, [], [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    wanted = F.array(*map(F.lit, weights))
    return placed.withColumn("weight", F.element_at(wanted, ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long")).drop("place")


def targets(sources: DataFrame, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, weight) with ``target``.

    The level is the target of a unit of weight. Sources that reach their limit at a level leave; the
    rest of the words over the rest of the weights is the next level, which is never lower, so it ends
    when no source leaves. Each round is one aggregation.
    """
    limit = F.col("source_size") * most
    exact = "decimal(38,0)"
    full = F.lit(False)
    told, level = None, (0, 1)
    while True:
        row = sources.agg(
            F.sum("source_size"), F.sum(F.when(full, limit).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.count_if(full)
        ).first()
        total, used, weight, left = (x or 0 for x in row)
        if left == told or not weight:
            break
        told, level = left, (share.numerator * total - share.denominator * used, share.denominator * weight)
        full = F.col("weight").cast(exact) * F.lit(level[0]).cast(exact) >= limit.cast(exact) * F.lit(level[1]).cast(exact)
    even = F.col("weight").cast("double") * F.lit(float(level[0])) / F.lit(float(level[1]))
    return sources.withColumn("target", F.when(full, limit.cast("double")).otherwise(even))


def planned(
    docs: DataFrame,
    keep: list[str],
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: Fraction = SHARE,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """``keep`` of every row with mix: struct (size, source_size, target, copies).

    ``copies`` is how often the mix takes the row. Null text has no words, a null source is a source of
    its own, after all others. Rows equal in id, source and text draw one by one (which of them is
    taken more often is open, how many is not). A source without words has target 0 and is not taken.
    An empty table gives no rows; the struct takes the name ``mix``, with ``_`` added while ``keep`` has it.
    """
    identity = F.concat_ws(
        "|",
        F.coalesce(col(doc_id).cast("string"), F.lit("")),
        F.when(col(source).isNull(), "-").otherwise(F.concat(F.lit("+"), col(source))),
        F.md5(F.coalesce(col(text), F.lit(""))),
    )
    kept = F.struct(*(col(c).alias(f"column_{i}") for i, c in enumerate(keep))) if keep else F.lit(None).cast("int")
    rows = materialise(docs.select(kept.alias("kept"), col(source).alias("source"), words(col(text)).alias("size"), F.md5(identity).alias("document")))
    totals = materialise(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = materialise(targets(materialise(weighted(totals, weights)), share, most)).withColumnRenamed("source", "source_is")

    numbered = running(rows, ["document"], [], {"copy": F.lit(1)})
    joined = numbered.join(sources, F.col("source").eqNullSafe(F.col("source_is")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    drawn = F.md5(F.concat_ws("|", "document", F.lit(seed), F.col("copy").cast("string")))
    chance = F.conv(F.substring(drawn, 1, DRAW_BITS // 4), 16, 10).cast("double") / float(1 << DRAW_BITS)
    copies = F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)
    mix = F.struct("size", "source_size", "target", copies.cast("long").alias("copies"))
    return joined.select(*(F.col(f"kept.column_{i}").alias(c) for i, c in enumerate(keep)), mix.alias(fresh("mix", docs.select(*map(col, keep)))))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns as they are; see ``planned``."""
    plan = planned(docs, docs.columns, **options)
    times = F.sequence(F.lit(1), F.col(plan.columns[-1])["copies"])
    taken = plan.where(F.col(plan.columns[-1])["copies"] > 0)
    return taken.withColumn(fresh("time", plan), F.explode(times)).select(*map(col, docs.columns))
