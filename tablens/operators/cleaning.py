"""Row filters, de-duplication and imputation (median, mean, random forest).

Imputers fit a small statistics table (one row per group) with a grouped
aggregate and apply it with a size-checked broadcast join + ``coalesce``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, long_form, numeric_columns
from tablens.functions.joins import attach
from tablens.functions.numeric import missing_to_null, nan_to_null
from tablens.functions.quantiles import quantile_table
from tablens.session import compact


# ---------------------------------------------------------------- filters

def filter_rules(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Keep rows passing every SQL predicate in ``rules``.

    SQL three-valued logic drops rows where a predicate is NULL, which is the
    reference's "missing fails" outcome. Floating columns are NaN-normalised to NULL
    first (Spark orders NaN above every number, so ``NaN > 1`` would pass).
    """
    out = df.select(*[nan_to_null(c).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])
    for r in rules:
        out = out.filter(F.expr(r))
    return out


def plausibility_rules(a_len: str, a_wid: str, b_len: str, b_wid: str, factor: float = 1.5) -> list[str]:
    """Row rules: b_len ≤ f·a_len, b_wid ≤ f·a_wid, all four > 0."""
    return [f"`{b_len}` <= {factor} * `{a_len}`", f"`{b_wid}` <= {factor} * `{a_wid}`"] + \
        [f"`{c}` > 0" for c in (a_len, a_wid, b_len, b_wid)]


def filter_allowed(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(list(allowed)))


def filter_positive(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose ``columns`` are all positive; a missing value (NULL or NaN) is not."""
    cond = F.lit(True)
    for c in as_list(columns):
        cond = cond & (nan_to_null(c) > 0)
    return df.filter(cond)


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate removal (NULL equals NULL); one hash aggregate, map-side combined."""
    return df.dropDuplicates(as_list(subset) or None)


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = as_list(columns) or df.columns
    cond = F.lit(True)
    for c in columns:
        x = F.col(c)
        dt = dict(df.dtypes)[c]
        cond = cond & x.isNotNull() & ((~F.isnan(x)) if dt in ("double", "float") else F.lit(True))
    return df.filter(cond)


# ---------------------------------------------------------------- simple imputers

def _fill(df: DataFrame, stats: DataFrame, group: list[str], columns: list[str], suffix: str) -> DataFrame:
    j = attach(df, stats, group, how="left") if group else df.crossJoin(F.broadcast(stats))
    return j.select(*[(F.coalesce(nan_to_null(c), F.col(f"{c}{suffix}")).alias(c) if c in columns else F.col(c))
                      for c in df.columns])


def impute_median(df: DataFrame, columns: Sequence[str] | None = None, group=None,
                  quantile_method: str = "exact") -> DataFrame:
    """Missing → exact median of the column (within the group when ``group`` is set)."""
    group = as_list(group)
    columns = as_list(columns) or numeric_columns(df, exclude=group)
    base = df
    for g in group:
        base = base.filter(F.col(g).isNotNull())
    lf = long_form(base, columns, ids=group, variable="column_name")
    med = quantile_table(lf, group + ["column_name"], {"m": 0.5}, method=quantile_method)
    wide = med.groupBy(*group).agg(*[F.max(F.when(F.col("column_name") == c, F.col("m"))).alias(f"{c}__fill")
                                     for c in columns])
    wide, _ = compact(wide)
    return _fill(df, wide, group, columns, "__fill")


def impute_mean(df: DataFrame, columns: Sequence[str] | None = None, group=None) -> DataFrame:
    """Missing → column mean (within the group when ``group`` is set)."""
    group = as_list(group)
    columns = as_list(columns) or numeric_columns(df, exclude=group)
    stats = df.groupBy(*group).agg(*[F.avg(nan_to_null(c)).alias(f"{c}__fill") for c in columns])
    return _fill(df, stats, group, columns, "__fill")


# ---------------------------------------------------------------- model-based imputers (Spark ML)

def _with_filled(df: DataFrame, columns: list[str], prefix: str, lacking: Sequence[str] | None = None) -> DataFrame:
    """``df`` plus median-filled copies ``prefix + column``, carried in the same row; only ``lacking`` ones (all by default) need a median."""
    wide = df.select("*", *[nan_to_null(c).cast("double").alias(f"{prefix}{c}") for c in columns])
    lacking = columns if lacking is None else [c for c in columns if c in lacking]
    return impute_median(wide, [f"{prefix}{c}" for c in lacking]) if lacking else wide


def impute_random_forest(df: DataFrame, columns: Sequence[str], key: Sequence[str] | str | None = None,
                         num_trees: int = 100, seed: int = 42, predictors: Sequence[str] | None = None) -> DataFrame:
    """Per column: a distributed regression forest fitted on the rows where the column
    is present (the other features median-filled), predicting the rows where it is missing.

    The filled features travel in the row itself, so no row is joined with another. All models are fitted on
    the same filled rows and applied in one pass over the rows that lack a column, however many
    columns there are; complete rows pass through unscored. ``key`` isn't needed (kept for callers that have one;
    a key that repeats is refused). ``predictors`` defaults to ``columns``.
    """
    from tablens.operators import forest

    columns, key, names = as_list(columns), as_list(key), list(df.columns)
    feats_all = list(dict.fromkeys(as_list(predictors) or columns))
    if key and not df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
        raise ValueError(f"key {key} repeats")
    both = list(dict.fromkeys([*columns, *feats_all]))
    seen = df.agg(*[F.count_if(nan_to_null(c).isNull()).alias(f"_miss_{c}") for c in both],
                  *[F.avg(nan_to_null(c).cast("double")).alias(f"_mean_{c}") for c in columns]).first()
    miss = {c: seen[f"_miss_{c}"] for c in both}
    feats = {c: [x for x in feats_all if x != c] for c in columns if miss[c]}
    feats = {c: f for c, f in feats.items() if f}
    for c in feats:
        if seen[f"_mean_{c}"] is None:
            raise ValueError(f"column {c} has no value to learn from")
    used = [x for x in feats_all if any(x in f for f in feats.values())]
    work = _with_filled(df, used, "_feat_", [x for x in used if miss[x]])
    cuts = forest.cut_points(work, [f"_feat_{x}" for x in used]) if used else {}
    work = work.select("*", *[forest.bin_of(F.col(x), cuts[x]).alias(f"_bin{x}") for x in cuts])
    fitted = {}
    for c, own in feats.items():
        bins = [f"_bin_feat_{x}" for x in own]
        train = work.filter(nan_to_null(c).isNotNull()).select(*bins, nan_to_null(c).alias("_target"))
        model = forest.fit_regression(train, bins, "_target", seen[f"_mean_{c}"], num_trees, seed)
        fitted[c] = forest.predicted(model, bins)
    lacking = F.lit(False)
    for c in fitted:
        lacking = lacking | nan_to_null(c).isNull()
    filled = {c: F.coalesce(nan_to_null(c), p).cast(df.schema[c].dataType).alias(c) for c, p in fitted.items()}
    lack = work.filter(lacking).select(*[filled.get(c, F.col(c)) for c in names])
    out = work.filter(~lacking).select(*names).unionByName(lack)
    return missing_to_null(out, [c for c in columns if miss[c]])


def impute_label(df: DataFrame, label: str, features: Sequence[str], num_trees: int = 100,
                 seed: int = 42) -> DataFrame:
    """Missing labels predicted by a ``RandomForestClassifier`` trained on labelled rows.

    Labelled rows pass through unscored; a table without any label comes back as it is.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler

    features, names = as_list(features), list(df.columns)
    have = F.col(label).isNotNull()
    if df.filter(have).isEmpty():
        return df
    work = _with_filled(df, features, "_feat_")
    feats = [f"_feat_{c}" for c in features]
    va = VectorAssembler(inputCols=feats, outputCol="_features", handleInvalid="keep")
    known = work.filter(have)
    idx = StringIndexer(inputCol=label, outputCol="_target", stringOrderType="alphabetAsc").fit(known)
    model = RandomForestClassifier(featuresCol="_features", labelCol="_target", numTrees=num_trees, seed=seed) \
        .fit(va.transform(idx.transform(known)))
    back = IndexToString(inputCol="prediction", outputCol="_label", labels=idx.labels)
    lack = back.transform(model.transform(va.transform(work.filter(~have)))).withColumn(label, F.col("_label"))
    return known.select(*names).unionByName(lack.select(*names))


# ---------------------------------------------------------------- compositions

def clean(df: DataFrame, columns: Sequence[str] | None = None, rules: Sequence[str] = (),
          handle_missing: str = "median", remove_duplicates: bool = True, round_digits: int | None = 1,
          key=None, label: str | None = None, num_trees: int = 100) -> DataFrame:
    """De-duplicate → impute → rule filter → half-even rounding.

    ``handle_missing``: ``median``, ``mean``, ``knn`` (the mean of the nearest rows), ``model_based``
    (a random forest per column), ``drop`` or ``none``. With ``label``, missing labels are predicted from the imputed columns.
    """
    columns = as_list(columns) or numeric_columns(df, skip_id=True)
    out = drop_duplicates(df) if remove_duplicates else df
    if handle_missing == "median":
        out = impute_median(out, columns)
    elif handle_missing == "mean":
        out = impute_mean(out, columns)
    elif handle_missing == "knn":
        from tablens.operators.neighbors import impute_knn
        out = impute_knn(out, columns, key)
    elif handle_missing == "model_based":
        out = impute_random_forest(out, columns, key, num_trees)
    elif handle_missing == "drop":
        out = complete_cases(out, columns)
    elif handle_missing != "none":
        raise ValueError(f"unknown missing-value strategy {handle_missing!r}")
    if label and handle_missing not in ("drop", "none"):
        out = impute_label(out, label, columns, num_trees)
    out = filter_rules(out, rules)
    if round_digits is not None:
        out = out.select(*[(F.bround(c, round_digits).alias(c) if c in columns else F.col(c)) for c in out.columns])
    return out


def ensure_consistency(df: DataFrame, columns: Sequence[str], label: str | None = None,
                       allowed: Sequence | None = None, rules: Sequence[str] = (),
                       round_digits: int = 1) -> DataFrame:
    """Allowed labels → coerce to numbers → positive measures → round → rule filter → de-duplicate.

    Rounding precedes de-duplication, so rows equal after rounding collapse.
    """
    from tablens.functions.numeric import to_number
    cols = set(as_list(columns))
    out = df
    if label and allowed is not None:
        out = filter_allowed(out, label, allowed)
    dt = dict(df.dtypes)
    out = out.select(*[(to_number(F.col(c)) if dt[c] == "string" else nan_to_null(c)).alias(c) if c in cols
                       else F.col(c) for c in out.columns])
    out = filter_positive(out, columns)
    out = out.select(*[F.bround(F.col(c), round_digits).alias(c) if c in cols else F.col(c) for c in out.columns])
    out = filter_rules(out, rules)
    return out.dropDuplicates()
