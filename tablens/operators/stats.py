"""Descriptive statistics, group statistics, correlation, importance, top-k reports.

Everything per column runs on the long form ``(group..., column_name, value)``:
one scan, one shuffle for the moments, the exact quantile engine for the
percentiles, and two map-side-combined group-bys for distinct counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, long_form, numeric_columns, string_columns
from tablens.functions.numeric import inv_norm_cdf, kolmogorov_sf, nan_to_null, norm_cdf, safe_corr
from tablens.functions.quantiles import quantile_table
from tablens.functions.ranking import rank_distinct

# Report limits.
PROFILE_PROBS = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
DESCRIBE_PROBS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
SHAPE_MIN_ROWS = 8
GROUP_STATS_MAX_LEVELS = 30
STRONG_CORRELATION = 0.7
TOP_VALUES = 5
IMPORTANCE_CV_WEIGHT = 0.7
IMPORTANCE_CORR_WEIGHT = 0.3
IMPORTANCE_MIN_MEAN = 1e-10
RANK_CHUNK = 1_000_000


def _dtype_col(df: DataFrame, columns: list[str]):
    dt = dict(df.dtypes)
    m = F.create_map(*itertools.chain.from_iterable((F.lit(c), F.lit(dt[c])) for c in columns))
    return F.element_at(m, F.col("column_name"))


def profile(df: DataFrame, columns: Sequence[str] | None = None, group=None,
            probs=None, quantile_method: str = "exact") -> DataFrame:
    """Per (group, column): count, missing, mean, std, variance, min, percentiles, max, n_unique, dtype."""
    group = as_list(group)
    columns = as_list(columns) or numeric_columns(df, exclude=group)
    probs = probs or PROFILE_PROBS
    base_df = df
    for g in group:
        base_df = base_df.filter(F.col(g).isNotNull())
    lf = long_form(base_df, columns, ids=group, drop_nulls=False, variable="column_name")
    keys = group + ["column_name"]
    mom = lf.groupBy(*keys).agg(
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("missing"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.var_samp("value").alias("variance"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = quantile_table(lf, keys, probs, method=quantile_method).drop("n")
    nu = lf.filter(F.col("value").isNotNull()).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_c")) \
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("n_unique"))
    out = mom.join(q, keys, "left").join(nu, keys, "left")
    return out.select(*keys, F.col("count").cast("long").alias("count"), F.col("missing").cast("long").alias("missing"),
                      "mean", "std", "variance", "min", *probs.keys(), "max",
                      F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"),
                      _dtype_col(df, columns).alias("dtype"))


def describe(df: DataFrame, columns=None, group=None, digits: int | None = None) -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max (optionally half-even rounded)."""
    p = profile(df, columns, group, probs=DESCRIBE_PROBS)
    keys = as_list(group) + ["column_name"]
    vals = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return p.select(*keys, "count", *[(F.bround(v, digits) if digits is not None else F.col(v)).alias(v)
                                      for v in vals])


def measurement_stats(df: DataFrame, columns=None, digits: int = 2) -> DataFrame:
    """min, max, mean, std, IQR, each half-even rounded to ``digits``."""
    p = profile(df, columns, probs={"p25": 0.25, "p75": 0.75})
    return p.select("column_name", *[F.bround(c, digits).alias(c) for c in ("min", "max", "mean", "std")],
                    F.bround(F.col("p75") - F.col("p25"), digits).alias("iqr"))


def shape_stats(df: DataFrame, columns=None, min_rows: int = SHAPE_MIN_ROWS) -> DataFrame:
    """Skewness (biased g1) and excess kurtosis for columns with more than ``min_rows`` values."""
    columns = as_list(columns) or numeric_columns(df)
    lf = long_form(df, columns, variable="column_name")
    return lf.groupBy("column_name").agg(F.count("value").alias("n"), F.skewness("value").alias("skewness"),
                                         F.kurtosis("value").alias("kurtosis")) \
        .filter(F.col("n") > min_rows)


def normality(df: DataFrame, columns=None) -> DataFrame:
    """Full-data normality statistics per column.

    * Jarque–Bera ``n/6·(g1² + g2²/4)`` with p = exp(−JB/2) (χ² with 2 df), from moments.
    * Shapiro–Francia ``W′ = corr(x₍ᵢ₎, Φ⁻¹((i − 3/8)/(n + 1/4)))²`` over every value:
      exact global ranks come from ``rank_distinct`` (range-partitioned), tied runs are
      cut into ``RANK_CHUNK`` pieces before expansion so no task expands a hot value alone.
      Its p-value is Royston's: ln(1 − W′) is about normal with mean and deviation that follow from
      n (fitted for 5 to 5,000 values, extended beyond; null below 5 or on a constant column).
    """
    columns = as_list(columns) or numeric_columns(df)
    lf = long_form(df, columns, variable="column_name")
    mom = lf.groupBy("column_name").agg(F.count("value").alias("n"), F.skewness("value").alias("g1"),
                                        F.kurtosis("value").alias("g2"))
    mom = mom.withColumn("jarque_bera", F.col("n") / 6.0 * (F.col("g1") ** 2 + F.col("g2") ** 2 / 4.0)) \
             .withColumn("jb_pvalue", F.exp(-F.col("jarque_bera") / 2.0))
    rk = rank_distinct(lf, ["column_name"])
    chunks = rk.select("column_name", "value", "start_rank", "c",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / RANK_CHUNK)))
                       .alias("_chunk"))
    chunks = chunks.withColumn("_lo", F.col("start_rank") + F.col("_chunk") * RANK_CHUNK) \
        .withColumn("_hi", F.least(F.col("_lo") + RANK_CHUNK - 1, F.col("start_rank") + F.col("c") - 1))
    chunks = chunks.repartition("column_name", "value", "_chunk")
    ranks = chunks.select("column_name", "value", F.explode(F.sequence("_lo", "_hi")).alias("i"))
    n = mom.select("column_name", "n")
    ranks = ranks.join(F.broadcast(n), "column_name")
    m = inv_norm_cdf((F.col("i") - 0.375) / (F.col("n") + 0.25))
    w = ranks.groupBy("column_name").agg(safe_corr(F.col("value"), m).alias("_r"))
    out = mom.join(w, "column_name", "left").withColumn("shapiro_francia_w", F.col("_r") * F.col("_r"))
    u = F.log(F.col("n").cast("double"))
    v = F.log(u)
    # Royston's coefficients.
    mean, dev = -1.2725 + 1.0521 * (v - u), 1.0308 - 0.26758 * (v + 2.0 / u)
    z = F.when((F.col("n") >= 5) & (F.col("shapiro_francia_w") < 1), (F.log(1 - F.col("shapiro_francia_w")) - mean) / dev)
    p = F.when((F.col("n") >= 5) & (F.col("shapiro_francia_w") >= 1), F.lit(1.0)).otherwise(1 - norm_cdf("_z"))
    return out.withColumn("_z", z).withColumn("sf_pvalue", p).select(
        "column_name", "n", "jarque_bera", "jb_pvalue", "shapiro_francia_w", "sf_pvalue")


# ---------------------------------------------------------------- categorical

def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, count)`` of non-missing values."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")) \
        .agg(F.count(F.lit(1)).alias("count"))


def most_least_common(df: DataFrame, column: str) -> DataFrame:
    """Most and least common value; ties go to the smallest value.

    Aggregates only (no un-partitioned window): the extreme count is a one-row
    aggregate attached by broadcast, then ``min(value)`` among the rows holding it.
    """
    vc = value_counts(df, column)
    ext = vc.agg(F.max("count").alias("_mx"), F.min("count").alias("_mn"))
    j = vc.crossJoin(F.broadcast(ext))
    most = j.filter(F.col("count") == F.col("_mx")).agg(F.min("value").alias("value"), F.max("count").alias("count"))
    least = j.filter(F.col("count") == F.col("_mn")).agg(F.min("value").alias("value"), F.max("count").alias("count"))
    return most.select(F.lit("most_common").alias("kind"), "value", "count") \
        .unionByName(least.select(F.lit("least_common").alias("kind"), "value", "count"))


def top_values(df: DataFrame, columns=None, k: int = TOP_VALUES) -> DataFrame:
    """Top-k values per text column by count (ties by value) with ``n_unique``.

    ``row_number`` ≤ k is planned with a partial ``WindowGroupLimit`` before the shuffle.
    """
    columns = as_list(columns) or string_columns(df)
    lf = df.select(*[F.col(c).cast("string").alias(c) for c in columns]) \
        .unpivot([], columns, "column_name", "value").filter(F.col("value").isNotNull())
    cnt = lf.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column_name").orderBy(F.desc("count"), "value")
    top = cnt.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    nu = cnt.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"))
    return top.join(F.broadcast(nu), "column_name").select("column_name", "rank", "value", "count", "n_unique")


def group_means(df: DataFrame, group: str, columns=None) -> DataFrame:
    columns = as_list(columns) or numeric_columns(df, exclude=[group])
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(*[F.avg(nan_to_null(c)).alias(c) for c in columns])


def group_stats(df: DataFrame, categoricals=None, columns=None, max_levels: int = GROUP_STATS_MAX_LEVELS,
                quantile_method: str = "exact") -> DataFrame:
    """For every text column with fewer than ``max_levels`` distinct values: per level and
    numeric column, mean, median, rows of the level (``count``, missing cells included), sample std.

    All categoricals are handled in one pass by unpivoting them next to the numeric
    long form: ``(group_column, level, column_name, value)``.
    """
    from tablens.operators.quality import distinct_counts
    categoricals = as_list(categoricals) or string_columns(df)
    columns = as_list(columns) or numeric_columns(df)
    dc = distinct_counts(df, categoricals).filter(F.col("n_unique") < max_levels).collect()
    cats = [r[0] for r in dc]
    if not cats:
        return df.sparkSession.createDataFrame([], "group_column string, level string, column_name string, "
                                                   "mean double, median double, count long, std double")
    lf = long_form(df.select(*[F.col(c).cast("string").alias(c) for c in cats], *columns), columns,
                   ids=cats, drop_nulls=False, variable="column_name")
    lf = lf.unpivot(["column_name", "value"], cats, "group_column", "level").filter(F.col("level").isNotNull())
    keys = ["group_column", "level", "column_name"]
    mom = lf.groupBy(*keys).agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("count"),
                                F.stddev_samp("value").alias("std"))
    med = quantile_table(lf, keys, {"median": 0.5}, method=quantile_method).drop("n")
    return mom.join(med, keys, "left").select(*keys, "mean", "median", F.col("count").cast("long").alias("count"),
                                              "std")


def variance_ranking(df: DataFrame, columns=None) -> DataFrame:
    """``(column_name, variance, rank)`` with rank 1 = highest variance (ties by name)."""
    columns = as_list(columns) or numeric_columns(df)
    lf = long_form(df, columns, variable="column_name")
    v = lf.groupBy("column_name").agg(F.var_samp("value").alias("variance"))
    return v.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("variance"), "column_name")))


# ---------------------------------------------------------------- correlation

def correlation_long(df: DataFrame, columns=None, digits: int | None = None, absolute: bool = False,
                     include_diagonal: bool = True) -> DataFrame:
    """Pearson correlation for every ordered column pair: ``(col1, col2, corr)``.

    One aggregate computes the p(p−1)/2 pairwise-complete moment sets; the symmetric
    long matrix is produced by exploding the one-row result. Zero spread → NULL.
    """
    columns = as_list(columns) or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[safe_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("col1"), F.lit(b).alias("col2"), F.col(f"c{i}").alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("col1"), F.lit(a).alias("col2"), F.col(f"c{i}").alias("corr")))
    out = row.select(F.explode(F.array(*cells)).alias("_s")).select("_s.*")
    if not include_diagonal:
        out = out.filter(F.col("col1") != F.col("col2"))
    val = F.col("corr")
    if absolute:
        val = F.abs(val)
    if digits is not None:
        val = F.bround(val, digits)
    return out.select("col1", "col2", val.alias("corr"))


def top_correlations(df: DataFrame, columns=None, n: int = 3, digits: int = 2) -> DataFrame:
    """Strongest |r| pairs from the upper triangle (missing dropped), ties by names."""
    columns = as_list(columns) or numeric_columns(df)
    order = {c: i for i, c in enumerate(columns)}
    c = correlation_long(df, columns, digits=digits, absolute=True, include_diagonal=False)
    pos = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v)) for k, v in order.items()))
    c = c.filter((F.element_at(pos, F.col("col1")) < F.element_at(pos, F.col("col2"))) & F.col("corr").isNotNull())
    return c.orderBy(F.desc("corr"), "col1", "col2").limit(n)


def strong_correlations(df: DataFrame, columns=None, threshold: float = STRONG_CORRELATION) -> DataFrame:
    """Pairs (upper triangle) with |r| > threshold on the 3-dp value, strongest first."""
    columns = as_list(columns) or numeric_columns(df)
    order = {c: i for i, c in enumerate(columns)}
    pos = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v)) for k, v in order.items()))
    c = correlation_long(df, columns, digits=3, include_diagonal=False)
    return c.filter((F.element_at(pos, F.col("col1")) < F.element_at(pos, F.col("col2")))
                    & (F.abs("corr") > threshold)).orderBy(F.desc(F.abs(F.col("corr"))), "col1", "col2")


def feature_importance(df: DataFrame, columns=None, digits: int = 4) -> DataFrame:
    """``0.7·cv/max(cv) + 0.3·Σ|corr|/(p−1)`` normalised to sum 1.

    cv = sample std / |mean| (0 when |mean| ≤ 1e-10); the |corr| sum includes the
    self-correlation. One column → importance 1.
    """
    columns = as_list(columns) or numeric_columns(df)
    p = len(columns)
    if p == 1:
        return df.sparkSession.range(1).select(F.lit(columns[0]).alias("column_name"),
                                               F.lit(1.0).alias("importance"))
    lf = long_form(df, columns, variable="column_name")
    m = lf.groupBy("column_name").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    m = m.withColumn("cv", F.when(F.abs("mean") > IMPORTANCE_MIN_MEAN, F.col("std") / F.abs("mean"))
                     .otherwise(F.lit(0.0)))
    corr = correlation_long(df, columns).groupBy(F.col("col1").alias("column_name")) \
        .agg(F.sum(F.abs(F.col("corr"))).alias("corr_sum"))
    j = m.join(corr, "column_name")
    w = Window.partitionBy()
    j = j.withColumn("_raw", F.lit(IMPORTANCE_CV_WEIGHT) * F.coalesce(F.try_divide(F.col("cv"), F.max("cv").over(w)), F.lit(0.0))
                     + F.lit(IMPORTANCE_CORR_WEIGHT) * F.col("corr_sum") / F.lit(float(p - 1)))
    j = j.withColumn("importance", F.bround(F.try_divide(F.col("_raw"), F.sum("_raw").over(w)), digits))
    return j.select("column_name", "importance")


# ---------------------------------------------------------------- ordering reports

def head(df: DataFrame, key, n: int = 5) -> DataFrame:
    """First ``n`` rows by ``key`` (TakeOrderedAndProject: per-partition top-n, then merge)."""
    return df.orderBy(*as_list(key)).limit(n)


def top_groups(df: DataFrame, group: str, k: int = 3) -> DataFrame:
    """Largest groups by row count (ties by group value)."""
    return value_counts(df, group).orderBy(F.desc("count"), "value").limit(k)


def top_missing(df: DataFrame, k: int = 5) -> DataFrame:
    from tablens.operators.quality import missing_report
    return missing_report(df).filter(F.col("missing") > 0).orderBy(F.desc("missing"), "column_name").limit(k)


def insights(df: DataFrame, measures: Sequence[str], label: str, iqr_factor: float = 1.5) -> DataFrame:
    """Validity, label distribution, variance ranking, top correlations and IQR outlier
    counts as one long table ``(section, item, value)``."""
    from tablens.operators import outliers as O
    from tablens.operators.quality import positive_check
    parts = [positive_check(df, measures).select(F.lit("validity").alias("section"), F.col("check").alias("item"),
                                                 F.col("passed").cast("double").alias("value"))]
    parts.append(value_counts(df, label).select(F.lit("label_counts").alias("section"),
                                                F.col("value").cast("string").alias("item"),
                                                F.col("count").cast("double").alias("value")))
    parts.append(variance_ranking(df, measures).select(F.lit("variance_rank").alias("section"),
                                                       F.col("column_name").alias("item"),
                                                       F.col("rank").cast("double").alias("value")))
    parts.append(top_correlations(df, measures).select(F.lit("top_correlation").alias("section"),
                                                       F.concat_ws("~", "col1", "col2").alias("item"),
                                                       F.col("corr").alias("value")))
    b = O.fit_bounds(df, measures, "iqr", factor=iqr_factor, min_spread=1e-6, low_spread="omit")
    parts.append(O.outlier_counts(df, b).select(F.lit("iqr_outliers").alias("section"),
                                                F.col("column_name").alias("item"),
                                                F.col("outlier_count").cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ks_normal(df: DataFrame, columns) -> DataFrame:
    """Kolmogorov–Smirnov test of each column against a normal with its mean and sample deviation.

    ``(column_name, n, statistic, pValue)``: the greatest distance between the distribution of the values and
    the normal one, before and after each distinct value (exact ranks, ties included), and the Kolmogorov
    limit for ``sqrt(n)`` times it. Both are null for a column that is constant or has no values.
    """
    columns = as_list(columns)
    lf = long_form(df, columns, variable="column_name")
    moments = lf.groupBy("column_name").agg(F.count("value").alias("n"), F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    # One row per column.
    ranks = rank_distinct(lf, ["column_name"]).join(F.broadcast(moments), "column_name").where(F.col("_s") > 0)
    phi = ranks.withColumn("_z", (F.col("value") - F.col("_m")) / F.col("_s")).withColumn("_phi", norm_cdf("_z"))
    below, upto = (F.col("start_rank") - 1) / F.col("n"), (F.col("start_rank") + F.col("c") - 1) / F.col("n")
    d = phi.groupBy("column_name").agg(F.max(F.greatest(upto - F.col("_phi"), F.col("_phi") - below)).alias("statistic"))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    out = every.join(moments, "column_name", "left").join(d, "column_name", "left")
    return out.withColumn("_x", F.sqrt(F.col("n").cast("double")) * F.col("statistic")).select(
        "column_name", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "statistic", F.when(F.col("_x").isNotNull(), kolmogorov_sf("_x")).alias("pValue"))
