"""Data-quality checks: missing values, duplicates, constraint checks, issue detection.

Per-column checks are one aggregate over the scan (``count_if`` per column) turned
into a long table; distinct counts use the long form ``(column, value)`` grouped
twice instead of many ``count(distinct)`` (which would ``Expand`` every row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablens.functions.frames import as_list, long_form, numeric_columns, string_columns
from tablens.functions.joins import attach
from tablens.functions.numeric import is_numeric_text, missing_to_null, nan_to_null, ratio_below

# Issue-detection limits.
HIGH_CARDINALITY_RATIO = 0.9
SKEW_LIMIT = 3.0
NEAR_ZERO_VARIANCE = 1e-6


def _is_missing(df: DataFrame, c: str):
    x = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, missing, missing_pct)``; pct = 100·missing/rows, half-even to 2 dp."""
    columns = as_list(columns) or df.columns
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_is_missing(df, c)).alias(f"missing__{c}") for c in columns])
    out = row.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"missing__{c}").alias("missing"))
        for c in columns])).alias("_s")).select("_rows", "_s.*")
    return out.select("column_name", F.col("missing").cast("long").alias("missing"),
                      F.bround(F.try_divide(F.col("missing") * 100.0, F.col("_rows")), 2).alias("missing_pct"))


def rows_with_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = as_list(columns) or df.columns
    anym = F.lit(False)
    for c in columns:
        anym = anym | _is_missing(df, c)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(anym).alias("rows_with_missing"))


def dataset_summary(df: DataFrame) -> DataFrame:
    """``(column_name, dtype, n_rows, missing)`` for every column."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_is_missing(df, c)).alias(f"missing__{c}") for c in df.columns])
    dt = dict(df.dtypes)
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(dt[c]).alias("dtype"),
                        F.col(f"missing__{c}").alias("missing")) for c in df.columns]
    return row.select(F.col("_rows").alias("n_rows"), F.explode(F.array(*structs)).alias("_s")) \
        .select("_s.column_name", "_s.dtype", "n_rows", F.col("_s.missing").cast("long").alias("missing"))


def dtype_report(df: DataFrame) -> DataFrame:
    """Schema as a table ``(column_name, dtype, is_numeric)`` (no data pass)."""
    num = set(numeric_columns(df))
    rows = [(f.name, f.dataType.simpleString(), f.name in num) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, dtype string, is_numeric boolean")


def _repeated(df: DataFrame, subset: list[str], keep: Sequence[str] = ()) -> DataFrame:
    """The rows (``keep`` and ``subset``) whose 128-bit digest of ``subset`` is not alone, with it as ``_h1, _h2``.

    Only digests are shuffled to find them; null and its place count, -0.0 equals 0.0.
    """
    kinds = dict(df.dtypes)
    cells = [x for c in subset for x in (F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c), F.col(c).isNull())]
    hashed = df.select(*keep, *[c for c in subset if c not in keep], F.xxhash64(*cells).alias("_h1"), F.xxhash64(F.lit(1), *reversed(cells)).alias("_h2"))
    many = hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > 1).select("_h1", "_h2")
    return hashed.join(many, ["_h1", "_h2"], "left_semi")


def duplicate_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``(n_rows, duplicates, duplicate_pct)``: rows that repeat an earlier row (NULL = NULL).

    Rows are compared by all columns only where their digests meet.
    """
    subset = as_list(subset) or df.columns
    same = _repeated(df, subset).groupBy("_h1", "_h2", *subset).agg(F.count(F.lit(1)).alias("_c"))
    again = same.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicates"))
    r = df.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(F.broadcast(again))  # one row each
    return r.select(F.col("n_rows").cast("long").alias("n_rows"), F.col("duplicates").cast("long").alias("duplicates"),
                    F.bround(F.try_divide(F.col("duplicates") * 100.0, F.col("n_rows")), 2).alias("duplicate_pct"))


def duplicate_rows(df: DataFrame, key: str, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row (all but the first by ``key`` order): ``(key, first_key)``.

    Rows are compared by all columns only where their 128-bit digests meet, which AQE joins by size
    and splits when one group is hot. NULL equals NULL.
    """
    subset = as_list(subset) or [c for c in df.columns if c != key]
    rows = _repeated(df, subset, [key])
    groups = rows.groupBy("_h1", "_h2", *subset).agg(F.count(F.lit(1)).alias("_c"), F.min(key).alias("first_key")).filter(F.col("_c") > 1)
    groups = groups.select("_h1", "_h2", "first_key", *[F.col(c).alias(f"_g_{c}") for c in subset])
    same = F.lit(True)
    for c in subset:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return rows.join(groups, ["_h1", "_h2"]).filter(same & (F.col(key) != F.col("first_key"))).select(key, "first_key")


# ---------------------------------------------------------------- constraint checks

def ratio_check(df: DataFrame, numerator: str, denominator: str, limit: float = 10.0) -> DataFrame:
    """``all rows: numerator / denominator < limit`` → ``(check, passed, violations)``."""
    ok = ratio_below(numerator, denominator, limit)
    return df.agg(F.lit(f"{numerator}/{denominator}<{limit:g}").alias("check"),
                  F.coalesce(F.bool_and(ok), F.lit(True)).alias("passed"),
                  F.count_if(~ok).alias("violations"))


def positive_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    columns = as_list(columns)
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.coalesce(nan_to_null(c) > 0, F.lit(False))
    return df.agg(F.lit("all_positive").alias("check"), F.coalesce(F.bool_and(ok), F.lit(True)).alias("passed"),
                  F.count_if(~ok).alias("violations"))


def domain_check(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    ok = F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))
    return df.agg(F.lit(f"{column}_in_domain").alias("check"),
                  F.coalesce(F.bool_and(ok), F.lit(True)).alias("passed"),
                  F.count_if(~ok).alias("violations"))


# ---------------------------------------------------------------- issue detection

def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, n_unique)``: distinct non-missing values per column (two grouped shuffles)."""
    columns = as_list(columns) or df.columns
    kinds = dict(df.dtypes)

    def as_text(c):
        x = F.col(c)
        if kinds[c] in ("double", "float"):  # -0.0 + 0.0 is 0.0: one value, one text
            x = F.nanvl(x, F.lit(None).cast(kinds[c])) + F.lit(0.0)
        # A long text is told from another by its digest: the shuffled value stays short.
        text = x.cast("string")
        return (F.when(F.length(text) > 64, F.sha2(text.cast("binary"), 256)).otherwise(text) if kinds[c] == "string" else text).alias(c)

    lf = df.select(*[as_text(c) for c in columns]).unpivot([], columns, "column_name", "value").filter(F.col("value").isNotNull())
    per = lf.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_c"))
    found = per.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"))
    allc = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return allc.join(F.broadcast(found), "column_name", "left") \
        .select("column_name", F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"))


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with at most one distinct non-missing value: least equals greatest, one scan, no shuffle of values."""
    columns = as_list(columns) or df.columns
    clean = missing_to_null(df, columns)
    row = clean.agg(*[x for c in columns for x in (F.min(c).alias(f"lo__{c}"), F.max(c).alias(f"hi__{c}"))])
    cells = [F.struct(F.lit(c).alias("column_name"), F.when(F.col(f"lo__{c}").isNull(), 0).when(F.col(f"lo__{c}") == F.col(f"hi__{c}"), 1)
                      .otherwise(2).cast("long").alias("n_unique")) for c in columns]
    return row.select(F.explode(F.array(*cells)).alias("_s")).select("_s.*").filter(F.col("n_unique") <= 1)


def high_cardinality(df: DataFrame, columns: Sequence[str] | None = None,
                     ratio: float = HIGH_CARDINALITY_RATIO) -> DataFrame:
    """Text columns with distinct/rows > ratio (rows include missing)."""
    columns = as_list(columns) or string_columns(df)
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    d = distinct_counts(df, columns).crossJoin(F.broadcast(n))
    return d.withColumn("unique_ratio", F.try_divide(F.col("n_unique").cast("double"), F.col("n_rows"))) \
        .filter(F.col("unique_ratio") > ratio).select("column_name", "n_unique", "n_rows", "unique_ratio")


def moment_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, n, mean, variance, skewness, kurtosis)`` — biased g1 and excess g2."""
    columns = as_list(columns) or numeric_columns(df)
    lf = long_form(df, columns, variable="column_name")
    return lf.groupBy("column_name").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("variance"),
        F.skewness("value").alias("skewness"), F.kurtosis("value").alias("kurtosis"))


def skewed_columns(df: DataFrame, columns=None, limit: float = SKEW_LIMIT) -> DataFrame:
    return moment_stats(df, columns).filter(F.abs("skewness") > limit).select("column_name", "skewness")


def near_zero_variance(df: DataFrame, columns=None, limit: float = NEAR_ZERO_VARIANCE) -> DataFrame:
    return moment_stats(df, columns).filter(F.col("variance") < limit).select("column_name", "variance")


def mixed_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns where some but not all rows parse as numbers (rows include missing)."""
    columns = as_list(columns) or string_columns(df)
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(is_numeric_text(c) & ~F.lower(F.trim(F.col(c))).isin("nan")).alias(f"numeric__{c}")
                   for c in columns])
    out = row.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"numeric__{c}").alias("numeric_count")) for c in columns]))
        .alias("_s")).select("_rows", "_s.*")
    return out.filter((F.col("numeric_count") > 0) & (F.col("numeric_count") < F.col("_rows"))) \
        .select("column_name", F.col("numeric_count").cast("long").alias("numeric_count"),
                F.col("_rows").cast("long").alias("n_rows"))


def quality_issues(df: DataFrame, key: str | None = None) -> DataFrame:
    """All issue detectors as one long table ``(issue, column_name, value)``."""
    parts = [
        missing_report(df).filter(F.col("missing") > 0)
        .select(F.lit("missing").alias("issue"), "column_name", F.col("missing").cast("double").alias("value")),
        constant_columns(df)
        .select(F.lit("constant").alias("issue"), "column_name", F.col("n_unique").cast("double").alias("value")),
    ]
    if string_columns(df):
        parts.append(high_cardinality(df).select(F.lit("high_cardinality").alias("issue"), "column_name",
                                                 F.col("unique_ratio").alias("value")))
        parts.append(mixed_types(df).select(F.lit("mixed_types").alias("issue"), "column_name",
                                            F.col("numeric_count").cast("double").alias("value")))
    if numeric_columns(df):
        m = moment_stats(df)
        parts.append(m.filter(F.abs("skewness") > SKEW_LIMIT)
                     .select(F.lit("skewed").alias("issue"), "column_name", F.col("skewness").alias("value")))
        parts.append(m.filter(F.col("variance") < NEAR_ZERO_VARIANCE)
                     .select(F.lit("near_zero_variance").alias("issue"), "column_name", F.col("variance").alias("value")))
    d = duplicate_report(df if key is None else df.drop(key))
    parts.append(d.filter(F.col("duplicates") > 0).select(F.lit("duplicates").alias("issue"),
                                                           F.lit(None).cast("string").alias("column_name"),
                                                           F.col("duplicates").cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def integrity_report(df: DataFrame, measures: Sequence[str], label: str | None = None,
                     allowed: Sequence | None = None, ratios: Sequence[tuple[str, str]] = (),
                     ratio_limit: float = 10.0) -> DataFrame:
    """Integrity report as one long table ``(section, column_name, metric, value, detail)``:
    missing counts, duplicate count, dtypes, constraint checks (value = violations,
    detail = passed) and measurement statistics (2 dp)."""
    from tablens.operators.stats import measurement_stats
    none = F.lit(None).cast("string")
    parts = [missing_report(df).select(F.lit("missing").alias("section"), "column_name", F.lit("missing").alias("metric"),
                                       F.col("missing").cast("double").alias("value"), none.alias("detail"))]
    parts.append(duplicate_report(df).select(F.lit("duplicates").alias("section"), none.alias("column_name"),
                                             F.lit("duplicates").alias("metric"),
                                             F.col("duplicates").cast("double").alias("value"), none.alias("detail")))
    parts.append(dataset_summary(df).select(F.lit("dtypes").alias("section"), "column_name", F.lit("dtype").alias("metric"),
                                            F.lit(None).cast("double").alias("value"), F.col("dtype").alias("detail")))
    checks = [positive_check(df, measures)] + [ratio_check(df, a, b, ratio_limit) for a, b in ratios]
    if label and allowed is not None:
        checks.append(domain_check(df, label, allowed))
    for c in checks:
        parts.append(c.select(F.lit("constraints").alias("section"), none.alias("column_name"), F.col("check").alias("metric"),
                              F.col("violations").cast("double").alias("value"),
                              F.when(F.col("passed"), "true").otherwise("false").alias("detail")))
    ms = measurement_stats(df, measures)
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("min", "max", "mean", "std", "iqr")])
    parts.append(ms.select("column_name", F.explode(cells).alias("_m")).select(
        F.lit("measurements").alias("section"), "column_name", "_m.metric", "_m.value", none.alias("detail")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
