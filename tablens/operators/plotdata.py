"""Reduced tables that charts draw (drawing itself is out of scope).

Point-level chart tables are capped per (column, group) with a hash-ranked
``row_number`` ≤ cap, which Spark plans as a partial ``WindowGroupLimit`` before
the shuffle, so a hot group never ships more than ``cap`` rows per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, long_form, numeric_columns, string_columns
from tablens.functions.numeric import nan_to_null
from tablens.functions.joins import attach
from tablens.functions.quantiles import quantile_table

# Chart limits.
BOX_WHISKER = 1.5
PAIR_SAMPLE = 100
BAR_MAX_LEVELS = 15
BAR_MAX_COLUMNS = 5
LINE_MAX_COLUMNS = 3


def box_stats(df: DataFrame, columns: Sequence[str] | None = None, group=None,
              whisker: float = BOX_WHISKER) -> DataFrame:
    """q1, median, q3, whiskers at the last value inside ``whisker``·IQR, flier count."""
    group = as_list(group)
    columns = as_list(columns) or numeric_columns(df, exclude=group)
    base = df
    for g in group:
        base = base.filter(F.col(g).isNotNull())
    lf = long_form(base, columns, ids=group, variable="column_name")
    keys = group + ["column_name"]
    q = quantile_table(lf, keys, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    rows = q._tablens_meta["rows"]
    j = attach(lf, q.select(*keys, "q1", "q3"), keys, known_rows=rows)
    lo = F.col("q1") - F.lit(whisker) * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + F.lit(whisker) * (F.col("q3") - F.col("q1"))
    a = j.groupBy(*keys).agg(F.min(F.when(F.col("value") >= lo, F.col("value"))).alias("whisker_low"),
                             F.max(F.when(F.col("value") <= hi, F.col("value"))).alias("whisker_high"),
                             F.count_if((F.col("value") < lo) | (F.col("value") > hi)).alias("n_fliers"))
    return q.join(a, keys).select(*keys, F.col("n").cast("long").alias("n"), "q1", "median", "q3",
                                  "whisker_low", "whisker_high", F.col("n_fliers").cast("long").alias("n_fliers"))


def box_fliers(df: DataFrame, key, columns: Sequence[str] | None = None, group=None,
               whisker: float = BOX_WHISKER) -> DataFrame:
    """Flier points ``(key..., group..., column_name, value)`` outside the whiskers."""
    from tablens.operators.outliers import fit_bounds, flag_rows
    b = fit_bounds(df, columns, "iqr", group, factor=whisker, min_spread=-1.0)
    return flag_rows(df, b, key, group).drop("method", "score")


def _capped(long: DataFrame, part: list[str], key: list[str], cap: int | None, seed: int) -> DataFrame:
    if not cap:
        return long
    w = Window.partitionBy(*part).orderBy(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), *key)
    return long.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= cap).drop("_r")


def strip_points(df: DataFrame, key, columns: Sequence[str] | None = None, group=None,
                 cap: int | None = None, seed: int = 42) -> DataFrame:
    """Long points ``(key..., group..., column_name, value)``, at most ``cap`` per (group, column)."""
    key, group = as_list(key), as_list(group)
    columns = as_list(columns) or numeric_columns(df, exclude=key + group)
    lf = long_form(df, columns, ids=key + group, variable="column_name")
    return _capped(lf, group + ["column_name"], key, cap, seed)


def pair_points(df: DataFrame, key, columns: Sequence[str] | None = None, group=None,
                sample: int | None = PAIR_SAMPLE, lower_only: bool = False, seed: int = 42) -> DataFrame:
    """Scatter-matrix points ``(key..., group..., x_col, y_col, x, y)`` for ordered column pairs
    of a hash sample of ``sample`` rows (``None`` → all rows)."""
    key, group = as_list(key), as_list(group)
    columns = as_list(columns) or numeric_columns(df, exclude=key + group)
    base = df.select(*key, *group, *columns)
    if sample:
        base = base.withColumn("_h", F.xxhash64(F.lit(seed), *[F.col(k) for k in key])) \
            .orderBy("_h", *key).limit(sample).drop("_h")
    pairs = [(a, b) for i, a in enumerate(columns) for j, b in enumerate(columns)
             if i != j and (not lower_only or i > j)]
    cells = F.array(*[F.struct(F.lit(a).alias("x_col"), F.lit(b).alias("y_col"),
                               F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
                      for a, b in pairs])
    return base.select(*key, *group, F.explode(cells).alias("_p")).select(*key, *group, "_p.*")


def scatter_points(df: DataFrame, key, columns: Sequence[str], extra: Sequence[str] = (),
                   cap: int | None = None, seed: int = 42) -> DataFrame:
    """Projection for 2-D/3-D scatter with size/colour columns, optionally hash-capped."""
    key = as_list(key)
    out = df.select(*key, *as_list(columns), *as_list(extra))
    if cap:
        out = out.withColumn("_h", F.xxhash64(F.lit(seed), *[F.col(k) for k in key])) \
            .orderBy("_h", *key).limit(cap).drop("_h")
    return out


def parallel_coordinates(df: DataFrame, label: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with the label's categorical code (missing → −1) next to the numeric columns."""
    from tablens.operators.features import category_codes
    columns = as_list(columns) or numeric_columns(df, exclude=[label])
    return category_codes(df.select(label, *columns), label, f"{label}_code")


def radar(df: DataFrame, group: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Group means in long form ``(group, column_name, mean)``."""
    columns = as_list(columns) or numeric_columns(df, exclude=[group])
    g = df.filter(F.col(group).isNotNull()).groupBy(group).agg(*[F.avg(nan_to_null(c)).alias(c) for c in columns])
    return g.unpivot([group], columns, "column_name", "mean")


def time_lines(df: DataFrame, ts: str, columns: Sequence[str] | None = None,
               step_seconds: int | None = None, max_columns: int | None = LINE_MAX_COLUMNS) -> DataFrame:
    """``(ts, column_name, value)`` ordered by time; with ``step_seconds`` the values are bucket means.

    Without a list the first ``max_columns`` numeric columns are drawn (None: all); a list is
    always drawn whole.
    """
    columns = as_list(columns) or numeric_columns(df)[:max_columns]
    lf = long_form(df.filter(F.col(ts).isNotNull()), columns, ids=[ts], variable="column_name")
    if step_seconds:
        us = int(step_seconds) * 1_000_000
        b = F.timestamp_micros(F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / us) * us).cast("timestamp_ntz")
        lf = lf.groupBy(b.alias(ts), "column_name").agg(F.avg("value").alias("value"))
    return lf.orderBy(ts, "column_name")


def category_bars(df: DataFrame, columns: Sequence[str] | None = None, max_levels: int = BAR_MAX_LEVELS,
                  max_columns: int | None = BAR_MAX_COLUMNS) -> DataFrame:
    """Value counts of the text columns with fewer than ``max_levels`` levels.

    Without a list the first ``max_columns`` text columns are looked at (None: all); a list is
    always used whole.
    """
    from tablens.operators.quality import distinct_counts
    columns = as_list(columns) or string_columns(df)[:max_columns]
    ok = {r[0] for r in distinct_counts(df, columns).filter(F.col("n_unique") < max_levels).collect()}
    cols = [c for c in columns if c in ok]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, value string, count long")
    lf = df.select(*[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([], cols, "column_name", "value").filter(F.col("value").isNotNull())
    return lf.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def heatmap_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full symmetric correlation matrix cells."""
    from tablens.operators.stats import correlation_long
    return correlation_long(df, columns)
