"""Running sums within keys of any size, by a scan over ordered ranges.

A window per key puts a key into one task. Here rows are dealt to ordered ranges, in which a key may
span many; sums run within (range, key), and what a key has in earlier ranges is added from a table
with at most one row a range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import materialise


def running(df: DataFrame, by: Sequence[str], order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """``df`` with a column for each of ``sums``: the sum over the rows of the same ``by`` up to this one.

    ``by`` holds no nulls and may be empty (one running sum over the whole table). Rows equal in
    ``order`` are taken in any order; summands hold no nulls. ``df`` is read twice (once for the
    bounds of the ranges), so write it before if it is costly. Starts a job: the dealt rows are
    written once. Columns named ``range_at`` and ``range_row`` are reserved.
    """
    # The row number lets one key with one place in the order span several ranges.
    keyed = df.withColumn("range_row", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*map(F.col, by), *order, F.col("range_row"))
    dealt = materialise(dealt.withColumn("range_at", F.spark_partition_id()))

    own = Window.partitionBy("range_at", *by).orderBy(*order, "range_row").rowsBetween(Window.unboundedPreceding, 0)
    within = dealt.withColumns({name: F.sum(value).over(own) for name, value in sums.items()})

    totals = dealt.groupBy("range_at", *by).agg(*(F.sum(value).alias(name) for name, value in sums.items()))
    if by:
        # Of the keys of a range only the least can have begun before it.
        first = dealt.groupBy("range_at").agg(F.min(F.struct(*by)).alias("key"))
        totals = totals.join(F.broadcast(first.select("key.*").distinct()), list(by), "leftsemi")
    earlier = Window.partitionBy(*by).orderBy("range_at").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("range_at", *by, *(F.sum(name).over(earlier).alias(f"{name}_before") for name in sums))
    before = before.where(F.col(f"{next(iter(sums))}_before").isNotNull())
    joined = within.join(F.broadcast(before), ["range_at", *by], "left")
    added = {name: F.col(name) + F.coalesce(F.col(f"{name}_before"), F.lit(0)) for name in sums}
    return joined.withColumns(added).select(*df.columns, *sums)
