"""Schema helpers and the long (unpivoted) form every per-column statistic uses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablens.functions.numeric import NUMERIC_TYPES, nan_to_null


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, str):
        return [x]
    return list(x)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (), skip_id: bool = False) -> list[str]:
    """Numeric columns in schema order (bool/string/date/timestamp are not numeric).

    ``skip_id`` leaves out columns whose name starts with ``id`` (case-insensitive).
    """
    ex = set(as_list(exclude))
    out = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, NUMERIC_TYPES) or f.name in ex:
            continue
        if skip_id and f.name.lower().startswith("id"):
            continue
        out.append(f.name)
    return out


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    ex = set(as_list(exclude))
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def temporal_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in as_list(columns) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def long_form(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = (),
              drop_nulls: bool = True, variable: str = "column", value: str = "value") -> DataFrame:
    """Unpivot numeric ``columns`` into ``(ids..., column, value double)``.

    One ``Expand`` over the scan; Catalyst prunes the scan to ``ids + columns``.
    NaN is normalised to NULL; ``drop_nulls`` removes missing values (pandas reductions skip them).
    """
    columns = as_list(columns)
    ids = as_list(ids)
    if not columns:
        raise ValueError("no columns to unpivot")
    proj = df.select(*[F.col(i) for i in ids], *[nan_to_null(c).alias(c) for c in columns])
    out = proj.unpivot(ids or [], columns, variable, value) if ids else \
        proj.unpivot([], columns, variable, value)
    if drop_nulls:
        out = out.filter(F.col(value).isNotNull())
    return out


def row_key(df: DataFrame, key: Sequence[str] | None, name: str = "_row_key") -> tuple[DataFrame, list[str]]:
    """Return ``(df, key_columns)``; without a key, derive one from the row content.

    The derived key is the sha256 of the row as JSON, which names its columns and leaves out
    NULLs, so (1, NULL) and (NULL, 1) differ; it is deterministic under recomputation (unlike
    ``monotonically_increasing_id``). Fully identical rows share a key, which is harmless for
    row flags because identical rows always get identical flags.
    """
    key = as_list(key)
    if key:
        return df, key
    text = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.withColumn(name, F.sha2(text.cast("binary"), 256)), [name]
