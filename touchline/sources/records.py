"""Fixture records as JSON text, in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_records(bodies: DataFrame, schema: T.StructType, column: str = "body") -> DataFrame:
    """Each body holds a JSON list of records; one output row per record."""
    parsed = F.from_json(F.col(column), T.ArrayType(schema))
    keep = [c for c in bodies.columns if c != column]
    return bodies.select(*keep, F.explode(parsed).alias("_record")).select(*keep, "_record.*")


def to_payload(df: DataFrame, column: str = "payload") -> DataFrame:
    """Each row as a JSON object: dates as ISO text, missing values as null, numbers as numbers."""

    def cell(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = F.when(~F.isnan(value), value)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd")
        return value.alias(field.name)

    body = F.to_json(F.struct(*[cell(f) for f in df.schema]), {"ignoreNullFields": "false"})
    return df.select(body.alias(column))
