"""Column roles: numeric / categorical / datetime, label column and id columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablens.functions.frames import numeric_columns, string_columns

# Name pattern of the label column and prefix of id columns.
LABEL_PATTERN = "species"
ID_PREFIX = "id"


def datetime_text_columns(df: DataFrame) -> list[str]:
    """Text columns where every non-null value parses as a timestamp (all-null counts too)."""
    cols = string_columns(df)
    if not cols:
        return []
    row = df.agg(*[F.count_if(F.col(c).isNotNull() & F.try_to_timestamp(F.col(c)).isNull()).alias(c)
                   for c in cols]).first()
    return [c for c in cols if row[c] == 0]


def column_roles(df: DataFrame, label_pattern: str = LABEL_PATTERN) -> DataFrame:
    """``(column_name, dtype, role, is_label, is_id)`` with role numeric / datetime / categorical."""
    num = set(numeric_columns(df))
    dt_text = set(datetime_text_columns(df))
    label = next((f.name for f in df.schema.fields if label_pattern.lower() in f.name.lower()), None)
    rows = []
    for f in df.schema.fields:
        if f.name in num:
            role = "numeric"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)) or f.name in dt_text:
            role = "datetime"
        else:
            role = "categorical"
        rows.append((f.name, f.dataType.simpleString(), role, f.name == label,
                     f.name.lower().startswith(ID_PREFIX)))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, dtype string, role string, is_label boolean, is_id boolean")


def promote_datetimes(df: DataFrame) -> DataFrame:
    """Cast every all-parsable text column to timestamp."""
    cols = set(datetime_text_columns(df))
    return df.select(*[F.try_to_timestamp(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
