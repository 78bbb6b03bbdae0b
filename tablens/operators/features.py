"""Column selection, derived features, label encoding and scaling.

Fitted state (label codes, scaler statistics) is a small DataFrame returned to
the caller and applied with a size-checked broadcast join, so the row-local half
also runs on a streaming DataFrame.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, numeric_columns
from tablens.functions.joins import attach
from tablens.functions.numeric import RATIO_EPSILON, missing_to_null, nan_to_null, ratio, to_number
from tablens.functions.ranking import rank_distinct


def select_features(df: DataFrame, keep: Sequence[str] | None = None,
                    exclude: Sequence[str] | None = ("Id",)) -> DataFrame:
    """``keep`` (every name must exist) else drop ``exclude`` (unknown names only warn)."""
    if keep:
        missing = [c for c in keep if c not in df.columns]
        if missing:
            raise ValueError(f"columns not found: {missing}")
        return df.select(*keep)
    ex = as_list(exclude)
    unknown = [c for c in ex if c not in df.columns]
    if unknown:
        warnings.warn(f"columns to exclude not found: {unknown}")
    return df.drop(*[c for c in ex if c in df.columns])


def add_ratio(df: DataFrame, numerator: str, denominator: str, name: str | None = None,
              epsilon: float | None = RATIO_EPSILON) -> DataFrame:
    """``numerator / (denominator + epsilon)`` (``epsilon=None`` → plain ratio); zero divisor → NULL."""
    return df.withColumn(name or f"{numerator}_{denominator}_ratio", ratio(numerator, denominator, epsilon))


def add_product(df: DataFrame, a: str, b: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{a}_{b}_product", F.col(a) * F.col(b))


def engineer_features(df: DataFrame, pairs: Sequence[tuple[str, str, str]], ratios: bool = True,
                      products: bool = True, epsilon: float | None = RATIO_EPSILON) -> DataFrame:
    """For each ``(prefix, a, b)``: ``<prefix>_ratio = a/(b+ε)`` and ``<prefix>_area = a·b``."""
    out = df
    for prefix, a, b in pairs:
        if ratios:
            out = add_ratio(out, a, b, f"{prefix}_ratio", epsilon)
        if products:
            out = add_product(out, a, b, f"{prefix}_area")
    return out


# ---------------------------------------------------------------- label encoding

def fit_label_encoder(df: DataFrame, column: str) -> DataFrame:
    """Mapping ``(label, code)``: sorted distinct non-null labels → 0..k−1.

    Codes are exact dense ranks from the range-partitioned ranking helper, so a
    label column with millions of levels is never sorted in one task.
    """
    d = df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
    r = rank_distinct(d, [], "value")
    return r.select(F.col("value").alias("label"), (F.col("start_rank") - 1).cast("int").alias("code"))


def encode_labels(df: DataFrame, mapping: DataFrame, column: str, output: str | None = None,
                  handle_invalid: str = "error", missing_code: int | None = None) -> DataFrame:
    """Attach the code of ``column``. Unseen non-null labels: ``error`` raises, ``keep`` → NULL.
    ``missing_code`` (e.g. −1) replaces the NULL code of missing/unseen labels."""
    output = output or f"{column}_encoded"
    m = mapping.select(F.col("label").alias("__label"), F.col("code").alias(output))
    j = attach(df, m.withColumnRenamed("__label", column), [column], how="left")
    if handle_invalid == "error":
        bad = j.filter(F.col(column).isNotNull() & F.col(output).isNull()).limit(1).count()
        if bad:
            raise ValueError(f"unseen labels in {column}")
    elif handle_invalid != "keep":
        raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
    if missing_code is not None:
        j = j.withColumn(output, F.coalesce(F.col(output), F.lit(missing_code)))
    return j.select(*df.columns, output)


def decode_labels(df: DataFrame, mapping: DataFrame, code_column: str, output: str = "label") -> DataFrame:
    m = mapping.select(F.col("code").alias(code_column), F.col("label").alias(output))
    return attach(df, m, [code_column], how="left")


def category_codes(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Codes of the sorted distinct labels; missing → −1."""
    return encode_labels(df, fit_label_encoder(df, column), column, output, handle_invalid="keep",
                         missing_code=-1)


# ---------------------------------------------------------------- scaling

def fit_scaler(df: DataFrame, columns: Sequence[str] | None = None, method: str = "standard",
               exclude: Sequence[str] = ()) -> DataFrame:
    """One-row statistics ``(column_name, shift, scale)`` in long form.

    standard: shift = mean, scale = population std (0 → 1); minmax: shift = min,
    scale = max − min (0 → 1, so a constant column maps to 0).
    """
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown scaling method {method!r}")
    columns = as_list(columns) or numeric_columns(df, exclude=exclude)
    if method == "standard":
        aggs = [x for c in columns for x in (F.avg(nan_to_null(c)).alias(f"s__{c}"),
                                            F.stddev_pop(nan_to_null(c)).alias(f"k__{c}"))]
    else:
        aggs = [x for c in columns for x in (F.min(nan_to_null(c)).alias(f"s__{c}"),
                                            (F.max(nan_to_null(c)) - F.min(nan_to_null(c))).alias(f"k__{c}"))]
    row = df.agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"s__{c}").alias("shift"),
                      F.when(F.col(f"k__{c}") == 0, F.lit(1.0)).otherwise(F.col(f"k__{c}")).alias("scale"))
             for c in columns]
    return row.select(F.explode(F.array(*cells)).alias("_s")).select("_s.*") \
        .withColumn("method", F.lit(method))


def _wide_stats(stats: DataFrame, columns: list[str]) -> DataFrame:
    return stats.agg(*[x for c in columns for x in (
        F.max(F.when(F.col("column_name") == c, F.col("shift"))).alias(f"{c}__shift"),
        F.max(F.when(F.col("column_name") == c, F.col("scale"))).alias(f"{c}__scale"))])


def apply_scaler(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    columns = as_list(columns)
    j = df.crossJoin(F.broadcast(_wide_stats(stats, columns)))
    return j.select(*[((nan_to_null(c) - F.col(f"{c}__shift")) / F.col(f"{c}__scale")).alias(c)
                      if c in columns else F.col(c) for c in df.columns])


def inverse_scale(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    columns = as_list(columns)
    j = df.crossJoin(F.broadcast(_wide_stats(stats, columns)))
    return j.select(*[(F.col(c) * F.col(f"{c}__scale") + F.col(f"{c}__shift")).alias(c)
                      if c in columns else F.col(c) for c in df.columns])


def scale_features(df: DataFrame, method: str = "standard", columns: Sequence[str] | None = None,
                   exclude: Sequence[str] = ("Id",)) -> tuple[DataFrame, DataFrame]:
    """Scale numeric columns (minus ``exclude``); returns ``(scaled, stats)`` for inversion."""
    columns = as_list(columns) or numeric_columns(df, exclude=exclude)
    if not columns:
        return df, None
    stats = fit_scaler(df, columns, method)
    return apply_scaler(df, stats, columns), stats


# ---------------------------------------------------------------- row-local transforms

def round_columns(df: DataFrame, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """Half-even rounding (NumPy/pandas ``round`` rule)."""
    cols = set(as_list(columns))
    return df.select(*[F.bround(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text → double, junk and 'NaN' → NULL."""
    cols = set(as_list(columns))
    return df.select(*[to_number(F.col(c).cast("string")).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def clip_columns(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Clip to fixed ``{column: (lower, upper)}``; missing (NULL, NaN) becomes NULL, a None bound is open."""
    df = missing_to_null(df, list(bounds))

    def clip(c, lo, hi):
        x = F.col(c)
        if lo is not None:
            x = F.when(x < F.lit(lo), F.lit(lo)).otherwise(x)
        if hi is not None:
            x = F.when(x > F.lit(hi), F.lit(hi)).otherwise(x)
        return x.alias(c)
    return df.select(*[clip(c, *bounds[c]) if c in bounds else F.col(c) for c in df.columns])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
         variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide → long (values default: numeric columns that are not ids)."""
    ids = as_list(ids)
    values = as_list(values) or numeric_columns(df, exclude=ids)
    cast = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    return cast.unpivot(ids, values, variable, value)
