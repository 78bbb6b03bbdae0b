"""Whole-table reports: compositions of operators over one input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, long_form, numeric_columns, string_columns
from tablens.operators import outliers as O
from tablens.operators import quality as Q
from tablens.operators import stats as S

# Sizes of the report's top-N cuts.
TOP_MISSING = 5
TOP_GROUPS = 3
TOP_CORRELATIONS = 5
TOP_FEATURES = 5


def top_features(df: DataFrame, columns: Sequence[str] | None = None, k: int = TOP_FEATURES) -> DataFrame:
    return S.feature_importance(df, columns).orderBy(F.desc("importance"), "column_name").limit(k)


def summary_report(df: DataFrame, measures: Sequence[str] | None = None, label: str | None = None,
                   key: str | None = None, ts: str | None = None, contamination: float = 0.05) -> dict[str, DataFrame]:
    """Dataset info, patterns, clusters, time patterns, anomalies, importance — a dict of DataFrames.

    Every value is a distributed DataFrame. Nothing is cached here: a caller that reads many
    parts may cache ``df`` before and release it afterwards. With ``key`` the rows are
    clustered (k by the elbow rule) and scored by an isolation forest; with ``ts`` the time
    patterns of every measure are added.
    """
    base = df
    measures = as_list(measures) or numeric_columns(df, exclude=[key] if key else [], skip_id=True)
    out = {
        "info": Q.dataset_summary(base),
        "missing": Q.missing_report(base),
        "top_missing": S.top_missing(base, TOP_MISSING),
        "describe": S.describe(base, measures),
        "shape": S.shape_stats(base, measures),
        "correlation": S.correlation_long(base, measures, digits=3),
        "strong_correlations": S.strong_correlations(base, measures),
        "top_correlations": S.top_correlations(base, measures, n=TOP_CORRELATIONS),
        "cardinality": S.top_values(base, string_columns(base)) if string_columns(base) else None,
        "anomalies": O.detect_many(base, measures),
        "importance": S.feature_importance(base, measures),
        "top_features": top_features(base, measures),
        "quality_issues": Q.quality_issues(base, key),
    }
    if label:
        out["group_stats"] = S.group_stats(base, [label], measures)
        out["top_groups"] = S.top_groups(base, label, TOP_GROUPS)
    if key:
        from tablens.operators import iforest, ml
        complete = base.select(key, *measures)
        assigned = ml.cluster(complete, measures, key)
        out["clusters"] = ml.cluster_profile(complete, assigned, key, measures)
        out["cluster_importance"] = ml.cluster_feature_importance(ml.cluster_centers(complete, assigned, key, measures))
        out["forest"] = iforest.anomaly_record(iforest.isolation_forest(complete, measures, key, contamination))
    if ts:
        from tablens.operators import timeseries
        out["calendar"] = timeseries.calendar_counts(base, ts)
        out["monthly_means"] = timeseries.monthly_means(base, ts, measures)
        out["gaps"] = timeseries.gap_stats(base, ts)
        out["periods"] = complex_patterns(base, ts, measures)
    return {k: v for k, v in out.items() if v is not None}


def report_rows(report: dict[str, DataFrame]) -> DataFrame:
    """A report as one table ``(section, row)``: every row of every part as JSON, nulls included."""
    parts = [part.select(F.lit(name).alias("section"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in part.columns]), {"ignoreNullFields": "false"}).alias("row"))
             for name, part in report.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def complex_patterns(df: DataFrame, ts: str, columns: Sequence[str], top: int = 3) -> DataFrame:
    """Step choice → resampling → the first ``top`` dominant bins by frequency, per measure.

    ``(column_name, step_seconds, k, frequency, period, power)``; all measures share the step,
    and each is one series of the same transform.
    """
    from tablens.operators import timeseries as TS
    step = TS.choose_step(df, ts).first()
    if step is None:
        raise ValueError(f"no time in {ts!r}")
    long = long_form(df.filter(F.col(ts).isNotNull()), columns, ids=[ts], variable="column_name")
    regular = TS.resample(long, ts, "value", step["step_seconds"], series="column_name")
    d = TS.dominant_periods(regular, series="column_name", top=top)
    return d.select("column_name", F.lit(step["step_seconds"]).alias("step_seconds"), "k", "frequency", "period", "power")
