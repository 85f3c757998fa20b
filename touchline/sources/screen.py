"""Rows kept and rows rejected, told apart, counted by reason and written in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from touchline.session import write_table

REASON, RECORD = "reject_reason", "reject_record"


@dataclass(frozen=True)
class Screened:
    """``kept`` rows, ``rejects`` (reject_reason, reject_record as text), and how many rows each reason took."""

    kept: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def screen(rows: DataFrame, reasons: Mapping[str, Column], record: Column, keep: Sequence[str]) -> Screened:
    """Split ``rows`` by the first of ``reasons`` that holds; a reason that is NULL does not hold.

    ``keep`` are the columns of kept rows, ``record`` what to show of a rejected one. Starts a job: all
    rows are written once, each kind to a folder of its own, and the counts are observed by that write.
    """
    why = F.lit(None).cast("string")
    for name, holds in reversed(reasons.items()):
        why = F.when(holds, name).otherwise(why)
    marked = rows.withColumn(REASON, why)
    out = marked.select(*keep, REASON, F.when(F.col(REASON).isNotNull(), record).alias(RECORD), F.col(REASON).isNotNull().alias("rejected"))
    seen = Observation()
    counts = [F.count_if(F.coalesce(F.col(REASON) == name, F.lit(False))).alias(name) for name in reasons]
    written = write_table(out.observe(seen, *counts), ["rejected"])
    return Screened(
        written.where(~F.col("rejected")).select(*keep),
        written.where("rejected").select(REASON, RECORD),
        {name: seen.get[name] for name in reasons},
    )
