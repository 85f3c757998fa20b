"""Feature frames made ready for a model: leakage, alignment, missing values."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.casts import present, to_double, to_match_date
from touchline.operators.quantiles import exact_quantiles

# Ids and repeats that are no features.
META = ("Division", "HomeTeam", "AwayTeam", "MatchDate", "MatchTime", "match_time_sort", "y_home_win")
# What is known only after the match.
POST_MATCH = (
    "FTHome FTAway HTHome HTAway HTResult HomeShots AwayShots HomeTarget AwayTarget HomeFouls AwayFouls "
    "HomeCorners AwayCorners HomeYellow AwayYellow HomeRed AwayRed shots_diff shots_on_target_diff "
    "shot_acc_home shot_acc_away shot_acc_diff fouls_diff yellow_diff red_diff corners_diff dominance_index"
).split()
# Further columns the boosted model leaves out.
BOOSTED_META = ("cfmd_match_id", "log_odds_away_vs_home")
# Columns the tuned model leaves out by name; FT*, HT* and y_* go by prefix.
TUNED_META = (
    "cfmd_match_id Division MatchDate MatchTime match_time_sort HomeTeam AwayTeam "
    "shots_diff shots_on_target_diff fouls_diff yellow_diff red_diff corners_diff dominance_index"
).split()
POST_SUFFIXES = ("Shots", "Target", "Fouls", "Yellow", "Red", "Corners")
SHOT_ACCURACY = ("shot_acc_home", "shot_acc_away", "shot_acc_diff")
# Columns whose absence is itself a signal.
MAY_BE_MISSING = tuple(
    f"{side}_{c}" for c in ("rest_days", "form_momentum", "elo_trend3", "elo_trend5") for side in ("home", "away")
)
LABEL = "y_outcome"


def leakage_columns(columns: list[str], mode: str = "baseline", keep_shot_accuracy: bool = False) -> list[str]:
    """Which of ``columns`` a model must not see.

    ``baseline`` and ``boosted`` are lists of names; ``tuned`` goes by rule: the
    label, FT*, HT*, and post-match counts of either side. The rule alone would
    leave shot accuracy in; it goes too unless ``keep_shot_accuracy``.
    """
    if mode in ("baseline", "boosted"):
        listed = {*META, *POST_MATCH, *(BOOSTED_META if mode == "boosted" else ())}
        return [c for c in columns if c in listed]
    if mode != "tuned":
        raise ValueError(f"unknown leakage mode: {mode}")

    def leaks(c: str) -> bool:
        if c in TUNED_META or c.startswith(("y_", "FT", "HT")):
            return True
        if c in SHOT_ACCURACY:
            return not keep_shot_accuracy
        return c.startswith(("Home", "Away")) and c.endswith(POST_SUFFIXES)

    return [c for c in columns if leaks(c)]


def drop_leakage(
    df: DataFrame, mode: str = "baseline", keep: tuple[str, ...] = (), keep_shot_accuracy: bool = False
) -> DataFrame:
    """``df`` without leaking columns and label; ``keep`` saves named ones."""
    gone = {*leakage_columns(df.columns, mode, keep_shot_accuracy), LABEL} - set(keep)
    return df.drop(*gone)


def split_types(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric column names, and the others."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return numeric, [c for c in df.columns if c not in numeric]


@dataclass(frozen=True)
class FeatureSchema:
    """What a stored model expects: columns in training order, their kinds, label order."""

    num_cols: tuple[str, ...]
    cat_cols: tuple[str, ...]
    columns: tuple[str, ...]
    classes: tuple[str, ...] = ("A", "D", "H")

    @staticmethod
    def of(df: DataFrame, classes: tuple[str, ...] = ("A", "D", "H")) -> FeatureSchema:
        numeric, other = split_types(df)
        return FeatureSchema(tuple(numeric), tuple(other), tuple(df.columns), classes)

    def to_json(self) -> str:
        return json.dumps(
            {
                "num_cols": self.num_cols,
                "cat_cols": self.cat_cols,
                "all_feature_cols_in_training_order": self.columns,
                "classes": self.classes,
            },
            indent=2,
        )

    @staticmethod
    def from_json(text: str) -> FeatureSchema:
        doc = json.loads(text)
        columns = tuple(doc.get("all_feature_cols_in_training_order", ()))
        if not columns:
            raise ValueError("the feature schema names no columns")
        return FeatureSchema(
            tuple(doc.get("num_cols", ())),
            tuple(doc.get("cat_cols", ())),
            columns,
            tuple(doc.get("classes", ("A", "D", "H"))),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """One small text file on whatever file system the path names."""
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureSchema:
        return FeatureSchema.from_json(spark.read.text(path, wholetext=True).first()[0])

    def struct(self) -> T.StructType:
        """Types of a fixture record: numbers as double, the rest as text."""
        kinds = [T.StructField(c, T.DoubleType() if c in self.num_cols else T.StringType()) for c in self.columns]
        return T.StructType(kinds)


# The 31 columns of a fixture record in training order.
FIXTURE_COLUMNS = (
    "match_date HomeElo AwayElo elo_diff elo_ratio Form3Home Form3Away form3_diff Form5Home Form5Away form5_diff "
    "OddHome OddDraw OddAway qh qd qa qsum p_home p_draw p_away overround MaxHome MaxDraw MaxAway "
    "log_odds_away_vs_home shot_acc_home shot_acc_away shot_acc_diff form_momentum_home form_momentum_away"
).split()
FIXTURE_SCHEMA = FeatureSchema(tuple(FIXTURE_COLUMNS[1:]), ("match_date",), tuple(FIXTURE_COLUMNS))


def align_zero(df: DataFrame, schema: FeatureSchema, carry: tuple[str, ...] = ()) -> DataFrame:
    """The model's columns in its order; an absent column is 0, an empty cell stays empty."""
    columns = [F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in schema.columns]
    return df.select(*carry, *columns)


def align_coerce(df: DataFrame, schema: FeatureSchema, carry: tuple[str, ...] = ()) -> DataFrame:
    """The model's columns in its order with its types.

    Numbers that do not parse and absent numeric columns are NULL; ``match_date``
    is read as a date (ISO or yyyymmdd), other columns stay as they are.
    """

    def cell(c: str) -> Column:
        if c not in df.columns:
            kind = "double" if c in schema.num_cols else "date" if c == "match_date" else "string"
            return F.lit(None).cast(kind).alias(c)
        if c in schema.num_cols:
            # Numbers are not written out and read again. Floats are: as text they have fewer digits.
            number = isinstance(df.schema[c].dataType, (T.DoubleType, T.IntegralType))
            return (F.col(c).cast("double") if number else to_double(c)).alias(c)
        return (to_match_date(c) if c == "match_date" else F.col(c)).alias(c)

    return df.select(*carry, *[cell(c) for c in schema.columns])


# The columns an entry form hands over as floats.
FORCE_FLOAT = (
    "OddHome OddDraw OddAway qh qd qa qsum p_home p_draw p_away overround MaxHome MaxDraw MaxAway "
    "log_odds_away_vs_home shot_acc_home shot_acc_away shot_acc_diff form_momentum_home form_momentum_away elo_ratio"
).split()


def coerce_float(df: DataFrame, columns: list[str] | tuple[str, ...] = tuple(FORCE_FLOAT)) -> DataFrame:
    return df.withColumns({c: to_double(c) for c in columns if c in df.columns})


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(present(c), F.lit(0.0)) for c in columns})


def missing_flags(df: DataFrame, columns: tuple[str, ...] = MAY_BE_MISSING) -> DataFrame:
    """A 0/1 column ``<name>__is_na`` for each listed column that exists."""
    return df.withColumns(
        {f"{c}__is_na": present(c).isNull().cast("int") for c in columns if c in df.columns}
    )


def median_table(df: DataFrame, columns: list[str], source: str = "own") -> DataFrame:
    """One row per split with the exact median of each column.

    ``own``    every split has its own medians;
    ``train``  every split gets those of the training rows.
    """
    if source not in ("own", "train"):
        raise ValueError(f"unknown median source: {source}")
    rows = df if source == "own" else df.where(F.col("split") == "train")
    long = exact_quantiles(rows, columns, [0.5], by=["split"])
    wide = long.groupBy("split").agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_median_{c}") for c in columns]
    )
    if source == "own":
        return wide
    every = F.explode(F.array(*[F.lit(s) for s in ("train", "val", "test")])).alias("split")
    return wide.drop("split").select(every, "*")


def training_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Medians of the training rows as plain values: one row, as wide as ``columns``. A column without a value has none."""
    row = median_table(df, columns, "train").first()
    return {c: row[f"_median_{c}"] for c in columns if row is not None and row[f"_median_{c}"] is not None}


def fill_values(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Missing cells of each column replaced by its value."""
    return df.withColumns({c: F.coalesce(present(c), F.lit(float(v))) for c, v in values.items() if c in df.columns})


def median_impute(df: DataFrame, columns: list[str], source: str = "train") -> DataFrame:
    """Missing cells replaced by the median of their column; at most one median row per split is broadcast."""
    medians = median_table(df, columns, source)
    filled = {c: F.coalesce(present(c), F.col(f"_median_{c}")) for c in columns}
    joined = df.join(F.broadcast(medians), "split", "left").withColumns(filled)
    return joined.select(*df.columns)


def class_share(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Share of each class, over the labelled rows."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # over the class rows, a handful
    return counts.select(label, "n", (F.col("n") / total).alias("share"))


def class_weights(df: DataFrame, label: str = LABEL, name: str = "weight") -> DataFrame:
    """``df`` with balanced weights n / (classes * n_class); one row per class is broadcast."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    classes = Window.partitionBy(F.lit(1))  # the class rows, a handful
    weight = F.sum("_n").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("_n"))
    weights = counts.select(label, weight.alias(name))
    return df.join(F.broadcast(weights), label)
