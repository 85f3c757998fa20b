"""Splits in time order and slices by season."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.casts import col, to_int
from touchline.operators.quantiles import value_at_ranks
from touchline.sources.screen import Screened, screen

# Last day of training and of validation.
TRAIN_UNTIL, VAL_UNTIL = dt.date(2019, 6, 30), dt.date(2022, 6, 30)
# Seasons (by end year) of each slice, both ends included.
SLICES = (("train", 2005, 2016), ("valid", 2017, 2019), ("test", 2020, 2025))
# Fixed value: share of the rows for validation and for test.
FRACTION = 0.125
# Stands for "no date" where a join needs a value; behind every real day.
NO_DAY = dt.date(9999, 12, 31)


def season_slices(df: DataFrame, season: str = "season_end") -> DataFrame:
    """Rows inside one of the season ranges with their ``slice``; all slices in one pass."""
    year = to_int(season)
    label = F.lit(None).cast("string")
    for name, first, last in SLICES:
        label = F.when(year.between(first, last), name).otherwise(label)
    return df.withColumn("slice", label).where(F.col("slice").isNotNull())


def season_rejects(df: DataFrame, season: str = "season_end") -> DataFrame:
    """Rows whose season is present but not a number: a strict cast would fail on them."""
    return df.where(F.col(season).isNotNull() & to_int(season).isNull())


def screened_slices(df: DataFrame, season: str = "season_end") -> Screened:
    """Rows whose season is a number or missing, and those of which it is not, with counts; starts a job."""
    return screen(df, {"season_not_a_number": F.col(season).isNotNull() & to_int(season).isNull()}, F.to_json(F.struct(*df.columns)), df.columns)


def write_slices(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("slice").parquet(path)


def split_by_date(
    df: DataFrame, date: str = "match_date", train_until: dt.date = TRAIN_UNTIL, val_until: dt.date = VAL_UNTIL
) -> DataFrame:
    """``split`` by two cut-off days; undated rows belong to none (NULL)."""
    day = col(date)
    label = F.when(day <= F.lit(train_until), "train").when(day <= F.lit(val_until), "val").when(day.isNotNull(), "test")
    return df.withColumn("split", label)


def split_by_fraction(
    df: DataFrame,
    date: str = "match_date",
    tie: str = "match_no",
    val_fraction: float = FRACTION,
    test_fraction: float = FRACTION,
) -> DataFrame:
    """``split`` by shares of the rows in time order, undated rows last.

    ``tie`` is a numeric id that orders the rows of one day. No row gets a global
    number: days are counted, and the running total over the days (a table as
    long as the calendar) tells which days lie wholly in one part. Only for the
    day at a boundary is the id looked up at which it is cut, by jobs that start here.
    """
    rows = df.withColumn("_day", F.coalesce(F.col(date).cast("date"), F.lit(NO_DAY)))
    days = rows.groupBy("_day").agg(F.count(F.lit(1)).alias("day_rows"))
    # One row per calendar day: a single window group by design.
    calendar = Window.partitionBy(F.lit(0))
    total = F.sum("day_rows").over(calendar)
    upto = F.sum("day_rows").over(calendar.orderBy("_day"))
    n_val, n_test = F.floor(total * val_fraction), F.floor(total * test_fraction)
    placed = days.select(
        "_day",
        (upto - F.col("day_rows")).alias("before"),
        upto.alias("upto"),
        (total - n_val - n_test).alias("train_end"),
        (total - n_test).alias("val_end"),
    )

    def cut_at(end: str) -> Column:
        inside = (F.col("before") < F.col(end)) & (F.col(end) < F.col("upto"))
        return F.when(inside, F.col(end) - F.col("before") - 1)

    cuts = placed.select("_day", F.explode(F.array(cut_at("train_end"), cut_at("val_end"))).alias("rank"))
    # At most two days hold a boundary.
    wanted = {(r["_day"], r["rank"]) for r in cuts.where(F.col("rank").isNotNull()).collect()}
    boundary = rows.where(F.col("_day").isin([day for day, _ in wanted])).select("_day", F.col(tie).cast("bigint").alias("value"))
    found = value_at_ranks(boundary, ["value"], lambda group, *_: [r for day, r in wanted if day == group[0]], by=["_day"]) if wanted else {}
    ids = [(day, rank, value) for ((day,), _), values in found.items() for rank, value in values.items()]
    ids = df.sparkSession.createDataFrame(ids, "_day date, rank bigint, value bigint")

    def last_id(end: str, name: str) -> Column:
        return F.max(F.when(F.col("rank") == cut_at(end), F.col("value"))).alias(name)

    plan = (
        placed.join(F.broadcast(ids), "_day", "left")
        .groupBy("_day", "before", "upto", "train_end", "val_end")
        .agg(last_id("train_end", "train_id"), last_id("val_end", "val_id"))
    )

    def within(end: str, cut: str) -> Column:
        return (F.col("upto") <= F.col(end)) | F.coalesce(F.col(tie) <= F.col(cut), F.lit(False))

    label = F.when(within("train_end", "train_id"), "train").when(within("val_end", "val_id"), "val").otherwise("test")
    # One row per calendar day: broadcast size at any number of matches.
    return rows.join(F.broadcast(plan), "_day").select(*df.columns, label.alias("split"))
