"""Outlier bounds, row flags and treatment (IQR, z-score, modified z-score).

Two stages, as for any estimator: ``fit_bounds`` aggregates one small bounds table
(one row per group × column, computed from the long form in one shuffle), then
row-local operators apply it through a size-checked broadcast join. Grouped and
global detection are the same code (``group`` empty → global bounds).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, long_form, numeric_columns, row_key
from tablens.functions.joins import attach
from tablens.functions.numeric import missing_to_null, nan_to_null
from tablens.functions.quantiles import quantile_table
from tablens.session import compact

# Default limits of the detectors.
IQR_FACTOR = 1.5
ZSCORE_THRESHOLD = 3.0
MODIFIED_Z_THRESHOLD = 3.5
MODIFIED_Z_CONSTANT = 0.6745
MIN_SPREAD = {"iqr": 1e-8, "zscore": 1e-8, "zscore_sample": 1e-10, "modified_zscore": 1e-10}
MIN_ROWS = {"iqr": 1, "zscore": 1, "zscore_sample": 2, "modified_zscore": 3}
CAP_ZSCORE_THRESHOLD = 3.0

METHODS = ("iqr", "zscore", "zscore_sample", "modified_zscore")


def default_columns(df: DataFrame, group: Sequence[str] = ()) -> list[str]:
    """Numeric columns except id-like names and the group keys."""
    return numeric_columns(df, exclude=group, skip_id=True)


def fit_bounds(df: DataFrame, columns: Sequence[str] | None = None, method: str = "iqr",
               group: Sequence[str] | str | None = None, *, factor: float = IQR_FACTOR,
               threshold: float | None = None, min_spread: float | None = None,
               low_spread: str = "null", nulls: str = "ignore",
               quantile_method: str = "exact") -> DataFrame:
    """Bounds table ``(group..., column_name, method, n, center, spread, threshold, lower, upper, skipped)``.

    * ``iqr``: center = q1, spread = q3 − q1 (``q3`` kept in ``upper_q``); lower/upper =
      q1 − f·iqr, q3 + f·iqr; outliers strictly outside.
    * ``zscore``: population std; z = (x − mean)/std_pop; the skip test uses the
      sample std. ``nulls='propagate'`` reproduces the all-missing z of a column
      with any missing value (zero outliers).
    * ``zscore_sample``: sample std, n ≥ 2.
    * ``modified_zscore``: 0.6745·(x − median)/MAD, n ≥ 3.

    A (group, column) whose spread is below ``min_spread`` (or with too few rows) is
    *skipped*: ``low_spread='null'`` keeps the row with NULL bounds and zero outliers,
    ``'omit'`` drops it.
    """
    if method not in METHODS:
        raise ValueError(f"unknown outlier method {method!r}; use one of {METHODS}")
    group = as_list(group)
    columns = as_list(columns) or default_columns(df, group)
    min_spread = MIN_SPREAD[method] if min_spread is None else min_spread
    if threshold is None:
        threshold = MODIFIED_Z_THRESHOLD if method == "modified_zscore" else ZSCORE_THRESHOLD
    base = df.filter(F.lit(True))
    for g in group:
        base = base.filter(F.col(g).isNotNull())
    keys = group + ["column_name"]
    lf = long_form(base, columns, ids=group, drop_nulls=False, variable="column_name")

    if method == "iqr":
        q = quantile_table(lf, keys, {"_q1": 0.25, "_q3": 0.75}, method=quantile_method)
        b = q.select(*keys, "n", F.col("_q1").alias("center"), (F.col("_q3") - F.col("_q1")).alias("spread"),
                     F.col("_q3").alias("upper_q"))
        lower = F.col("center") - F.lit(float(factor)) * F.col("spread")
        upper = F.col("upper_q") + F.lit(float(factor)) * F.col("spread")
        thr = float(factor)
        skip_spread = F.col("spread") < F.lit(min_spread)
    elif method in ("zscore", "zscore_sample"):
        sd = F.stddev_pop("value") if method == "zscore" else F.stddev_samp("value")
        b = lf.groupBy(*keys).agg(
            F.count("value").alias("n"), F.avg("value").alias("center"), sd.alias("spread"),
            F.stddev_samp("value").alias("_sd_samp"),
            F.count_if(F.col("value").isNull()).alias("_n_missing"))
        lower = F.col("center") - F.lit(float(threshold)) * F.col("spread")
        upper = F.col("center") + F.lit(float(threshold)) * F.col("spread")
        thr = float(threshold)
        if method == "zscore":
            skip_spread = F.coalesce(F.col("_sd_samp") < F.lit(min_spread), F.lit(True))
        else:
            skip_spread = F.coalesce(F.abs(F.col("spread")) < F.lit(min_spread), F.lit(True))
    else:  # modified_zscore
        med = quantile_table(lf, keys, {"center": 0.5}, method=quantile_method)
        med, n_med = compact(med)
        dev = attach(lf.filter(F.col("value").isNotNull()), med.select(*keys, "center"), keys,
                     known_rows=n_med) \
            .select(*keys, F.abs(F.col("value") - F.col("center")).alias("value"))
        mad = quantile_table(dev, keys, {"spread": 0.5}, method=quantile_method)
        b = attach(med, mad.select(*keys, "spread"), keys, "left", known_rows=n_med)
        half = F.lit(float(threshold)) * F.col("spread") / F.lit(MODIFIED_Z_CONSTANT)
        lower = F.col("center") - half
        upper = F.col("center") + half
        thr = float(threshold)
        skip_spread = F.coalesce(F.col("spread") < F.lit(min_spread), F.lit(True))

    skipped = skip_spread | (F.col("n") < F.lit(MIN_ROWS[method]))
    if method == "zscore" and nulls == "propagate":
        skipped = skipped | (F.col("_n_missing") > 0)
    out = b.withColumn("skipped", skipped) \
        .withColumn("lower", F.when(~F.col("skipped"), lower)) \
        .withColumn("upper", F.when(~F.col("skipped"), upper)) \
        .withColumn("method", F.lit(method)) \
        .withColumn("threshold", F.lit(thr))
    if low_spread == "omit":
        out = out.filter(~F.col("skipped"))
    out, rows = compact(out.select(*keys, "method", "n", "center", "spread", "threshold",
                                   "lower", "upper", "skipped"))
    out._tablens_meta = {"methods": [method], "columns": columns, "group": group, "rows": rows}
    return out


def _meta(bounds: DataFrame) -> dict:
    """Columns and row count of a fitted bounds table (read back if not recorded)."""
    m = getattr(bounds, "_tablens_meta", None)
    if m is None:
        rows = bounds.select("method", "column_name").distinct().collect()
        m = {"methods": sorted({r[0] for r in rows}), "columns": sorted({r[1] for r in rows}), "rows": bounds.count()}
        bounds._tablens_meta = m
    return m


def _outside(value=None, bound=None):
    """Row predicate for a value against its bounds row, by that row's own method."""
    b = (lambda n: F.col(n)) if bound is None else (lambda n: bound[n])
    v = F.col("value") if value is None else value
    z = F.try_divide(v - b("center"), b("spread"))
    return (F.when(b("method") == "iqr", (v < b("lower")) | (v > b("upper")))
            .when(b("method") == "modified_zscore", F.abs(F.lit(MODIFIED_Z_CONSTANT) * z) > b("threshold"))
            .otherwise(F.abs(z) > b("threshold")))


def _score():
    """The z-score of a cell by its bounds row's method; NULL for interval bounds."""
    z = F.try_divide(F.col("value") - F.col("center"), F.col("spread"))
    return F.when(F.col("method") == "modified_zscore", F.lit(MODIFIED_Z_CONSTANT) * z).when(F.col("method") != "iqr", z)


def _with_bounds(df: DataFrame, bounds: DataFrame, group, columns: list[str]) -> DataFrame:
    """``df`` with ``_bounds``: a map from column name to the bounds (one per method) of the row's group.

    One row per group is joined, so every later decision is row-local.
    """
    group = as_list(group)
    cells = F.struct("column_name", F.struct("method", "center", "spread", "threshold", "lower", "upper").alias("b"))
    kept = bounds.filter(~F.col("skipped") & F.col("column_name").isin(columns))
    wide = kept.groupBy(*group).agg(F.collect_list(cells).alias("_bounds"))
    if group:
        return attach(df, wide, group, how="left", known_rows=_meta(bounds)["rows"])
    return df.crossJoin(F.broadcast(wide))  # a global aggregate: one row


def _cell_outside(c: str):
    """Whether the row's cell ``c`` lies outside any of its bounds; missing cells and bounds don't."""
    v = nan_to_null(c)
    hit = F.exists("_bounds", lambda x: (x["column_name"] == c) & F.coalesce(_outside(v, x["b"]), F.lit(False)))
    return F.coalesce(hit, F.lit(False))


def _any_outside(columns: list[str]):
    cond = F.lit(False)
    for c in columns:
        cond = cond | _cell_outside(c)
    return cond


def keep_inside(df: DataFrame, bounds: DataFrame, group=None) -> DataFrame:
    """Rows without any cell outside its bounds: a filter, no key and no join of rows with rows."""
    columns = _meta(bounds)["columns"]
    return _with_bounds(df, bounds, group, columns).filter(~_any_outside(columns)).select(*df.columns)


def keep_outside(df: DataFrame, bounds: DataFrame, group=None) -> DataFrame:
    """Rows with at least one cell outside its bounds, as a filter."""
    columns = _meta(bounds)["columns"]
    return _with_bounds(df, bounds, group, columns).filter(_any_outside(columns)).select(*df.columns)


def _joined(df: DataFrame, bounds: DataFrame, group, ids):
    group = as_list(group)
    columns = _meta(bounds)["columns"]
    base = df
    for g in group:
        base = base.filter(F.col(g).isNotNull())
    lf = long_form(base, columns, ids=list(dict.fromkeys(ids + group)), variable="column_name")
    b = bounds.filter(~F.col("skipped"))
    return attach(lf, b, group + ["column_name"], known_rows=_meta(bounds)["rows"])


def flag_rows(df: DataFrame, bounds: DataFrame, key: Sequence[str] | str | None = None,
              group: Sequence[str] | str | None = None) -> DataFrame:
    """Flag table ``(key..., group..., column_name, method, value, score)``: one row per outlying cell."""
    group = as_list(group)
    df, key = row_key(df, key)
    j = _joined(df, bounds, group, key)
    return j.filter(_outside()).select(
        *dict.fromkeys(key + group), "column_name", "method", "value", _score().alias("score"))


def outlier_counts(df: DataFrame, bounds: DataFrame, group: Sequence[str] | str | None = None) -> DataFrame:
    """Bounds plus ``outlier_count`` per (group, column); skipped pairs count 0."""
    group = as_list(group)
    j = _joined(df, bounds, group, [])
    keys = group + ["column_name", "method"]
    cnt = j.groupBy(*keys).agg(F.count_if(_outside()).alias("outlier_count"))
    return attach(bounds, cnt, keys, how="left", known_rows=_meta(bounds)["rows"]) \
        .withColumn("outlier_count", F.coalesce("outlier_count", F.lit(0)).cast("long"))


def detect(df: DataFrame, columns=None, method: str = "iqr", group=None, **kw) -> DataFrame:
    """Bounds and outlier counts in one call (``find_anomalies`` per method)."""
    b = fit_bounds(df, columns, method, group, **kw)
    return outlier_counts(df, b, group)


def detect_many(df: DataFrame, columns=None, methods: Sequence[str] = ("iqr", "zscore_sample", "modified_zscore"),
                group=None, **kw) -> DataFrame:
    """Union of the per-method count tables; unknown method names are ignored."""
    outs = [detect(df, columns, m, group, **kw) for m in methods if m in METHODS]
    if not outs:
        raise ValueError("no known method given")
    res = outs[0]
    for o in outs[1:]:
        res = res.unionByName(o)
    return res


def flag_union(df: DataFrame, bounds_list: Sequence[DataFrame], key, group=None) -> DataFrame:
    """All flags of several bounds tables with a per-row vote count (methods × columns flagged)."""
    key = as_list(key)
    flags = [flag_rows(df, b, key, group) for b in bounds_list]
    u = flags[0]
    for f in flags[1:]:
        u = u.unionByName(f)
    return u.groupBy(*key).agg(F.count(F.lit(1)).alias("votes"),
                               F.count_distinct("method").alias("n_methods"))


def flagged_keys(flags: DataFrame, key) -> DataFrame:
    """Distinct row keys flagged by any column (UNION DISTINCT of the per-column id sets)."""
    return flags.select(*as_list(key)).distinct()


def _match(key: list[str]):
    cond = F.lit(True)
    for k in key:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_flag_{k}"))
    return cond


def remove_outliers(df: DataFrame, flags: DataFrame, key) -> DataFrame:
    """Drop every row whose key is flagged (NULL keys match NULL keys).

    For flags that aren't row-local, such as another table's; bounds of the same table are
    applied by ``keep_inside``.
    """
    key = as_list(key)
    f = flagged_keys(flags, key).select(*[F.col(k).alias(f"_flag_{k}") for k in key])
    return df.join(f, _match(key), "left_anti")


def outlier_rows(df: DataFrame, flags: DataFrame, key) -> DataFrame:
    """Rows whose key is flagged (NULL keys match NULL keys); see ``keep_outside`` for bounds."""
    key = as_list(key)
    f = flagged_keys(flags, key).select(*[F.col(k).alias(f"_flag_{k}") for k in key])
    return df.join(f, _match(key), "left_semi")


def _wide_bounds(bounds: DataFrame, group, columns, lo_col="lower", hi_col="upper") -> DataFrame:
    """One row per group with ``<col>__lo`` / ``<col>__hi`` columns (pivot of a small table)."""
    group = as_list(group)
    aggs = []
    for c in columns:
        aggs.append(F.max(F.when(F.col("column_name") == c, F.col(lo_col))).alias(f"{c}__lo"))
        aggs.append(F.max(F.when(F.col("column_name") == c, F.col(hi_col))).alias(f"{c}__hi"))
    return bounds.groupBy(*group).agg(*aggs)


def _clip(c: str):
    """Clip ``c`` to its bound columns; NULL bound = no limit; NULL value stays NULL."""
    x, lo, hi = F.col(c), F.col(f"{c}__lo"), F.col(f"{c}__hi")
    y = F.when(lo.isNotNull() & (x < lo), lo).otherwise(x)
    return F.when(hi.isNotNull() & (y > hi), hi).otherwise(y)


def apply_caps(df: DataFrame, bounds: DataFrame, group=None, columns=None) -> DataFrame:
    """Clip each column to its (group's) lower/upper bounds; other columns untouched."""
    group = as_list(group)
    columns = as_list(columns) or _meta(bounds)["columns"]
    wide = _wide_bounds(bounds, group, columns)
    j = attach(missing_to_null(df, columns), wide, group, how="left", known_rows=_meta(bounds)["rows"])
    return j.select(*[(_clip(c).alias(c) if c in columns else F.col(c)) for c in df.columns])


def cap_outliers(df: DataFrame, columns=None, method: str = "iqr", group=None, factor: float = IQR_FACTOR,
                 threshold: float | None = None) -> DataFrame:
    """Cap to the method's bounds.

    ``iqr``: quartiles ∓ factor · IQR; ``zscore``: mean ± 3 · sample std whatever threshold is
    set; ``zscore_sample`` and ``modified_zscore``: their own centre ∓ threshold · spread.
    """
    group = as_list(group)
    columns = as_list(columns) or default_columns(df, group)
    if method == "iqr":
        b = fit_bounds(df, columns, "iqr", group, factor=factor, min_spread=-1.0)
    elif method == "zscore":
        b = fit_bounds(df, columns, "zscore_sample", group, threshold=CAP_ZSCORE_THRESHOLD, min_spread=-1.0)
    elif method in METHODS:
        b = fit_bounds(df, columns, method, group, threshold=threshold)
    else:
        raise ValueError(f"unknown cap method {method!r}")
    return apply_caps(df, b, group, columns)


def impute_outliers(df: DataFrame, bounds: DataFrame, group=None, columns=None,
                    quantile_method: str = "exact") -> DataFrame:
    """Flagged cells (by the bounds' own method) → NULL → median of the remaining values of the group and column."""
    from tablens.operators.cleaning import impute_median
    group = as_list(group)
    columns = as_list(columns) or _meta(bounds)["columns"]
    j = _with_bounds(df, bounds, group, columns)
    masked = j.select(*[(F.when(~_cell_outside(c), F.col(c)).alias(c) if c in columns else F.col(c)) for c in df.columns])
    return impute_median(masked, columns, group=group, quantile_method=quantile_method)


def _forest_flags(df: DataFrame, columns, key, group, contamination: float) -> tuple[DataFrame, DataFrame, list[str]]:
    """Keyed rows, the flagged keys of the isolation forest and the key columns."""
    from tablens.operators import iforest
    df, key = row_key(df, key)
    r = iforest.isolation_forest_by_group(df, columns, key, group, contamination) if group else \
        iforest.isolation_forest(df, columns, key, contamination)
    return df, r.filter("is_outlier"), key


def handle(df: DataFrame, strategy: str = "remove", method: str = "zscore", columns=None, group=None,
           key=None, contamination: float = 0.05, **kw) -> DataFrame:
    """Front door: ``remove`` flagged rows, ``cap`` to bounds, or ``impute`` with group medians.

    Every bound method works with every strategy. ``isolation_forest`` flags whole rows:
    ``remove`` drops them; its rows have no bounds, so ``cap`` raises, and ``impute`` replaces
    the measured cells of flagged rows by the median of the others.
    """
    if strategy not in ("remove", "cap", "impute"):
        raise ValueError(f"unknown strategy {strategy!r}")
    group = as_list(group)
    columns = as_list(columns) or default_columns(df, group)
    if method == "isolation_forest":
        if strategy == "cap":
            raise ValueError("an isolation forest gives no bounds to cap to")
        keyed, flags, k = _forest_flags(df, columns, key, group, contamination)
        if strategy == "remove":
            return remove_outliers(keyed, flags, k).select(*df.columns)
        from tablens.operators.cleaning import impute_median
        f = flagged_keys(flags, k).select(*[F.col(x).alias(f"_flag_{x}") for x in k], F.lit(True).alias("_flagged"))
        masked = keyed.join(f, _match(k), "left").select(
            *[(F.when(F.col("_flagged").isNull(), F.col(c)).alias(c) if c in columns else F.col(c)) for c in df.columns])
        return impute_median(masked, columns, group=group)
    if strategy == "cap":
        return cap_outliers(df, columns, method, group, **{k: v for k, v in kw.items() if k in ("factor", "threshold")})
    b = fit_bounds(df, columns, method, group, **kw)
    return keep_inside(df, b, group) if strategy == "remove" else impute_outliers(df, b, group, columns)


def removal_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before/after and rows removed (``get_report``)."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return b.crossJoin(a).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after")) \
        .withColumn("n_columns", F.lit(len(after.columns)).cast("long"))


def outlier_analysis(df: DataFrame, columns=None, factor: float = IQR_FACTOR, min_spread: float = 1e-6) -> DataFrame:
    """IQR summary per column: ``(column_name, outlier_count, outlier_pct, lower, upper)``.

    Columns with IQR below ``min_spread`` are left out; the percentage is over all rows
    (missing included), half-even to 2 dp, and the bounds are rounded to 2 dp.
    """
    b = fit_bounds(df, columns, "iqr", factor=factor, min_spread=min_spread, low_spread="omit")
    c = outlier_counts(df, b)
    n = df.agg(F.count(F.lit(1)).alias("_rows"))
    return c.crossJoin(F.broadcast(n)).select(
        "column_name", "outlier_count",
        F.bround(F.col("outlier_count") * 100.0 / F.col("_rows"), 2).alias("outlier_pct"),
        F.bround("lower", 2).alias("lower"), F.bround("upper", 2).alias("upper"))


def find_anomalies(df: DataFrame, columns=None, key=None, methods: Sequence[str] = (
        "iqr", "zscore_sample", "modified_zscore", "isolation_forest"), group=None,
        contamination: float = 0.05) -> DataFrame:
    """Multi-method front: ``(key..., method, columns_flagged)`` for every flagged row.

    Bound methods flag cells (counted per row); ``isolation_forest`` flags rows (global, or
    one forest per group when ``group`` is set). Unknown method names are ignored.
    """
    from tablens.operators import iforest
    group = as_list(group)
    columns = as_list(columns) or default_columns(df, group)
    df, key = row_key(df, key)
    parts = []
    for m in methods:
        if m in METHODS:
            f = flag_rows(df, fit_bounds(df, columns, m, group), key, group)
            parts.append(f.groupBy(*key, "method").agg(F.count(F.lit(1)).alias("columns_flagged")))
        elif m == "isolation_forest":
            r = iforest.isolation_forest_by_group(df, columns, key, group, contamination) if group else \
                iforest.isolation_forest(df, columns, key, contamination)
            parts.append(r.filter("is_outlier").select(*key, F.lit("isolation_forest").alias("method"),
                                                      F.lit(len(columns)).cast("long").alias("columns_flagged")))
    if not parts:
        raise ValueError("no known method given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
