"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` has it (in either case)."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def plain_names(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with columns named by their place, and those names: functions in tasks trip over dots in names."""
    names = [f"column_{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def held_out(doc_id: str) -> Column:
    """True for the quarter of the documents that nothing is learned from; null ids are not held out."""
    return F.coalesce(F.crc32(col(doc_id).cast("string")) % 4 == 2, F.lit(False))
