"""Counts and summaries of a table."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.quantiles import exact_quantiles

# Columns per aggregation when pairs of columns are correlated.
PAIRS_PER_PASS = 1_000


def group_counts(df: DataFrame, keys: list[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def first_groups(df: DataFrame, keys: list[str], n: int = 20, name: str = "n_rows") -> DataFrame:
    """Row counts of the first ``n`` groups in key order."""
    order = [F.asc_nulls_last(k) for k in keys]
    return group_counts(df, keys, name).orderBy(*order).limit(n)


def row_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Several counts in one pass: all rows, and those that meet each condition."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, in value order; missing values are left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(column)


def _melt(row: DataFrame, columns: list[str], name: str) -> DataFrame:
    """A one-row aggregate as (column, value) rows."""
    return row.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in columns])).alias("e")
    ).select("e.*")


def null_profile(df: DataFrame, n: int | None = 20) -> DataFrame:
    """Missing cells per column, the ``n`` columns with most of them first."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    ranked = _melt(counts, df.columns, "n_missing").orderBy(F.desc("n_missing"), "column")
    return ranked.limit(n) if n else ranked


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample standard deviation, minimum, exact quartiles and maximum of each column."""
    statistics = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}

    def summary(c: str) -> Column:
        value = F.col(c).cast("double")
        seen = F.when(~F.isnan(value), value)
        return F.struct(*[f(seen).alias(name) for name, f in statistics.items()]).alias(c)

    row = df.agg(*[summary(c) for c in columns])
    basic = _melt(row, columns, "s").select("column", "s.*")
    shares = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    long = exact_quantiles(df, columns, list(shares))
    wide = long.groupBy("column").agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(name) for s, name in shares.items()]
    )
    # One row per described column on both sides.
    return basic.join(F.broadcast(wide), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, each over the rows that hold both.

    One aggregation per thousand pairs; the mirror half is filled in afterwards.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    parts = []
    for start in range(0, len(pairs), PAIRS_PER_PASS):
        some = pairs[start : start + PAIRS_PER_PASS]
        row = df.agg(
            *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(some)]
        )
        cells = [
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(some)
        ]
        parts.append(row.select(F.explode(F.array(*cells)).alias("e")).select("e.*"))
    half = parts[0]
    for part in parts[1:]:
        half = half.unionByName(part)
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    return half.select(F.explode(both).alias("p"), "r").select(
        F.col("p.a").alias("column_a"), F.col("p.b").alias("column_b"), F.col("r").alias("corr")
    )


def totals(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(c) for c in columns])


def overview(df: DataFrame) -> DataFrame:
    """Rows, columns, and columns per type."""
    kinds: dict[str, int] = {}
    for _, kind in df.dtypes:
        kinds[kind] = kinds.get(kind, 0) + 1
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        *[F.lit(n).alias(f"n_{kind}") for kind, n in sorted(kinds.items())],
    )


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order."""
    return df.orderBy(*order).limit(n)
