"""Time patterns: calendar counts, gap regularity, resampling, decomposition, periodicity.

No operator sorts a whole series inside one task:

* gaps come from ``rank_distinct`` (range-partitioned exact order, previous value
  stitched across partitions);
* resampling aggregates to buckets, then every populated bucket learns its
  predecessor the same way; empty buckets between two populated ones are
  generated from that pair (chunked, repartitioned) and linearly interpolated;
* the centred moving average of the decomposition is an aggregate: every point
  adds its weighted value to the ``period + 1`` (or ``period``) targets it belongs to;
* the DFT multiplies every point with each frequency and aggregates per frequency
  (short series) or runs a distributed four-step FFT whose groups hold about √n points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, numeric_columns
from tablens.functions.joins import attach
from tablens.functions.numeric import nan_to_null
from tablens.functions.quantiles import quantile_table
from tablens.functions.ranking import rank_distinct
from tablens.session import materialize

DECOMPOSE_BLOCK = 65_536

# Resampling step rule (average spacing → step) and period per step.
STEP_RULE = [(60, 1, "1s"), (3600, 60, "1min"), (86400, 3600, "1h")]
DEFAULT_STEP = (86400, "1d")
PERIOD_BY_STEP = {1: 60, 60: 60, 3600: 24, 86400: 7}
MIN_DECOMPOSE_POINTS = 12
MIN_FFT_POINTS = 24
FFT_POWER_PERCENTILE = 0.95
REGULARITY_EPSILON = 1e-10
GENERATE_CHUNK = 100_000


def _micros(ts: str):
    """Epoch microseconds of a TIMESTAMP or TIMESTAMP_NTZ column (the session time zone is UTC,
    so an NTZ wall clock is read as UTC)."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


# ---------------------------------------------------------------- calendar

def calendar_counts(df: DataFrame, ts: str) -> DataFrame:
    """Row counts by hour / day / weekday (Monday = 0) / month / year: ``(unit, value, count)``."""
    t = F.col(ts)
    units = F.array(*[F.struct(F.lit(u).alias("unit"), e.alias("value")) for u, e in (
        ("hour", F.hour(t)), ("day", F.dayofmonth(t)), ("weekday", F.weekday(t)),
        ("month", F.month(t)), ("year", F.year(t)))])
    return df.filter(t.isNotNull()).select(F.explode(units).alias("_u")) \
        .groupBy("_u.unit", "_u.value").agg(F.count(F.lit(1)).alias("count"))


def monthly_means(df: DataFrame, ts: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean of each numeric column by calendar month: ``(month, column_name, mean)``."""
    columns = as_list(columns) or numeric_columns(df)
    g = df.filter(F.col(ts).isNotNull()).groupBy(F.month(ts).alias("month")) \
        .agg(*[F.avg(nan_to_null(c)).alias(c) for c in columns])
    return g.unpivot(["month"], columns, "column_name", "mean").filter(F.col("mean").isNotNull())


# ---------------------------------------------------------------- gaps

# Calendar steps, the rarest first, and their names.
CALENDARS = (("year", "year start"), ("quarter", "quarter start"), ("quarter_end", "quarter end"), ("month", "month start"),
             ("month_end", "month end"), ("business", "business day"))
DAY_MICROS = 86_400_000_000


def _with_calendar(times: DataFrame) -> DataFrame:
    """``times`` with, for each calendar, whether ``value`` (microseconds) lies on it and its ordinal there."""
    day = F.expr(f"value div {DAY_MICROS}")
    date = F.date_from_unix_date(day.cast("int"))
    midnight = F.col("value") % DAY_MICROS == 0
    month = F.year(date) * 12 + F.month(date) - 1
    last = F.dayofmonth(F.date_add(date, 1)) == 1
    weekday = F.pmod(day + 3, F.lit(7))
    on = {"year": (F.dayofyear(date) == 1, F.year(date)), "quarter": ((F.dayofmonth(date) == 1) & (F.month(date) % 3 == 1), F.floor(month / 3)),
          "quarter_end": (last & (F.month(date) % 3 == 0), F.floor(month / 3)), "month": (F.dayofmonth(date) == 1, month), "month_end": (last, month),
          "business": (weekday < 5, F.floor((day + 3) / 7) * 5 + weekday)}
    return times.select("*", *[x for name, _ in CALENDARS for x in ((midnight & on[name][0]).alias(f"_on_{name}"), on[name][1].cast("long").alias(f"_at_{name}"))])


def gap_stats(df: DataFrame, ts: str, series: Sequence[str] | None = None) -> DataFrame:
    """Gaps between consecutive sorted timestamps: mean, population std, regularity
    ``1 − min(1, std/(mean + 1e-10))``, number of distinct gaps and the step when regular.

    ``calendar`` names the calendar step of a series whose gaps differ: three or more distinct times that are
    consecutive year, quarter or month starts, quarter or month ends, or business days (Monday to Friday), all at
    midnight. Such a series is regular (1) as well.
    """
    series = as_list(series)
    x = df.filter(F.col(ts).isNotNull()).select(*series, _micros(ts).alias("value"))
    rk = rank_distinct(x, series, "value")
    gap = (F.col("value") - F.col("prev_value")).cast("double") / 1e6
    per = _with_calendar(rk.select(*series, "c", gap.alias("g"), "value"))
    agg = per.groupBy(*series).agg(
        (F.sum("c") - 1).alias("n_gaps"), F.count("g").alias("_m"), F.avg("g").alias("_mean"), F.var_pop("g").alias("_var"),
        F.sum(F.coalesce("g", F.lit(0.0))).alias("_s"),
        F.count_distinct("g").alias("_nd"),
        F.max(F.when(F.col("c") > 1, 1).otherwise(0)).alias("_has_zero"),
        F.max("g").alias("_gmax"), F.count(F.lit(1)).alias("_distinct"),
        *[x for name, _ in CALENDARS for x in (F.every(f"_on_{name}").alias(f"_all_{name}"), (F.max(f"_at_{name}") - F.min(f"_at_{name}") + 1).alias(f"_len_{name}"))])
    mean = F.try_divide(F.col("_s"), F.col("n_gaps"))
    # Moments of the m gaps between distinct times, merged with the n - m gaps of zero between equal ones.
    m, zeros = F.col("_m").cast("double"), (F.col("n_gaps") - F.col("_m")).cast("double")
    var = F.try_divide(m * F.coalesce("_var", F.lit(0.0)) + F.try_divide(m * zeros, F.col("n_gaps")) * F.pow(F.coalesce("_mean", F.lit(0.0)), F.lit(2.0)),
                       F.col("n_gaps"))
    calendar = F.lit(None).cast("string")
    for name, label in reversed(CALENDARS):
        steady = F.col(f"_all_{name}") & (F.col(f"_len_{name}") == F.col("_distinct"))
        calendar = F.when(steady, F.lit(label)).otherwise(calendar)
    agg = agg.withColumn("calendar", F.when((F.col("_distinct") >= 3) & (F.col("_nd") > 1) & (F.col("_has_zero") == 0), calendar))
    out = agg.withColumn("mean_interval_seconds", mean) \
        .withColumn("std_interval_seconds", F.sqrt(var)) \
        .withColumn("regularity", F.when(F.col("calendar").isNotNull(), F.lit(1.0)).otherwise(
            1 - F.least(F.lit(1.0), F.col("std_interval_seconds") / (F.col("mean_interval_seconds") + REGULARITY_EPSILON)))) \
        .withColumn("distinct_gaps", F.col("_nd") + F.col("_has_zero")) \
        .withColumn("step_seconds", F.when(F.col("distinct_gaps") == 1, F.col("_gmax")))
    return out.filter(F.col("n_gaps") > 0).select(
        *series, F.col("n_gaps").cast("long").alias("n_gaps"), "mean_interval_seconds", "std_interval_seconds",
        "regularity", F.col("distinct_gaps").cast("long").alias("distinct_gaps"), "step_seconds", "calendar")


def choose_step(df: DataFrame, ts: str, series: Sequence[str] | None = None) -> DataFrame:
    """Resampling step from the average spacing range/n: < 60 s → 1 s, < 1 h → 1 min,
    < 1 day → 1 h, else 1 day."""
    series = as_list(series)
    a = df.filter(F.col(ts).isNotNull()).groupBy(*series).agg(
        ((F.max(_micros(ts)) - F.min(_micros(ts))) / 1e6).alias("range_seconds"),
        F.count(F.lit(1)).alias("n"))
    avg = F.col("range_seconds") / F.col("n")
    step, label = F.lit(DEFAULT_STEP[0]), F.lit(DEFAULT_STEP[1])
    for lim, s, lab in reversed(STEP_RULE):
        step = F.when(avg < lim, F.lit(s)).otherwise(step)
        label = F.when(avg < lim, F.lit(lab)).otherwise(label)
    return a.select(*series, "range_seconds", "n", avg.alias("avg_interval_seconds"),
                    step.alias("step_seconds"), label.alias("freq"))


# ---------------------------------------------------------------- resampling

def _chunked_range(df: DataFrame, lo: str, hi: str, out: str, keys: Sequence[str]) -> DataFrame:
    """Expand inclusive integer ranges ``[lo, hi]`` row-wise, in chunks spread over tasks."""
    ch = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.floor((F.col(hi) - F.col(lo)) / GENERATE_CHUNK))))
    ch = ch.withColumn("_clo", F.col(lo) + F.col("_chunk") * GENERATE_CHUNK) \
           .withColumn("_chi", F.least(F.col("_clo") + GENERATE_CHUNK - 1, F.col(hi)))
    ch = ch.repartition(*keys, "_chunk")
    return ch.withColumn(out, F.explode(F.sequence("_clo", "_chi"))).drop("_chunk", "_clo", "_chi")


def resample(df: DataFrame, ts: str, value: str, step_seconds: int, series: Sequence[str] | None = None,
             interpolate: bool = True) -> DataFrame:
    """Mean per ``step`` bucket, every bucket between the first and last present, empty
    buckets linearly interpolated: ``(series..., t, bucket_ts, value, populated)``.

    ``t`` is the bucket position from the series start (0, 1, ...). Rows with a missing
    value or time are dropped first.
    """
    series = as_list(series)
    step_us = int(step_seconds) * 1_000_000
    x = df.filter(F.col(ts).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    b = x.groupBy(*series, F.floor(_micros(ts) / step_us).cast("long").alias("bk")) \
        .agg(F.avg(F.col(value).cast("double")).alias("y"))
    rk = rank_distinct(b.select(*series, F.col("bk").alias("value")), series, "value") \
        .select(*series, F.col("value").alias("bk"), F.col("prev_value").alias("pbk"))
    pop = b.join(rk, [*series, "bk"])
    first = pop.groupBy(*series).agg(F.min("bk").alias("_bk0"))
    rows = pop.select(*series, "bk", "y", F.lit(True).alias("populated"))
    if interpolate:
        prev = b.select(*series, F.col("bk").alias("pbk"), F.col("y").alias("py"))
        seg = pop.filter(F.col("bk") - F.col("pbk") > 1).join(prev, [*series, "pbk"])
        seg = seg.withColumn("_lo", F.col("pbk") + 1).withColumn("_hi", F.col("bk") - 1)
        mid = _chunked_range(seg, "_lo", "_hi", "k", series)
        mid = mid.select(*series, F.col("k").alias("bk"),
                         (F.col("py") + (F.col("k") - F.col("pbk")) * (F.col("y") - F.col("py"))
                          / (F.col("bk") - F.col("pbk"))).alias("y"),
                         F.lit(False).alias("populated"))
        rows = rows.unionByName(mid)
    rows = attach(rows, first, series, known_rows=None) if series else rows.crossJoin(F.broadcast(first))
    return rows.select(*series, (F.col("bk") - F.col("_bk0")).alias("t"),
                       F.timestamp_micros(F.col("bk") * step_us).cast("timestamp_ntz").alias("bucket_ts"),
                       F.col("y").alias("value"), "populated")


# ---------------------------------------------------------------- decomposition

def decompose(regular: DataFrame, period: int | None = None, series: Sequence[str] | None = None, t: str = "t",
              value: str = "value", step_seconds: int | None = None) -> DataFrame:
    """Additive decomposition of a regular series ``(series..., t, value)``.

    trend: centred moving average of ``period`` points (even period: 2×MA, end weights
    ½), NULL where the window is incomplete; seasonal: mean detrended value per phase
    ``t mod period`` minus the mean of the phase means; resid = value − trend − seasonal.
    ``period`` defaults from the resampling step (1 s / 1 min → 60, 1 h → 24, 1 day → 7).
    Series shorter than ``max(12, 2·period)`` points are left out.
    """
    series = as_list(series)
    if period is None:
        if step_seconds not in PERIOD_BY_STEP:
            raise ValueError("give a period or one of the resampling steps " + str(sorted(PERIOD_BY_STEP)))
        period = PERIOD_BY_STEP[step_seconds]
    h = period // 2
    n_win = 2 * h + 1
    x = regular.select(*series, F.col(t).alias("t"), F.col(value).cast("double").alias("y"))
    sizes = x.groupBy(*series).agg(F.count(F.lit(1)).alias("_len")) \
        .filter(F.col("_len") >= max(MIN_DECOMPOSE_POINTS, 2 * period)).drop("_len")
    x = x.join(sizes, series, "left_semi") if series else x.crossJoin(F.broadcast(sizes.limit(1)))
    # Centred windows run inside blocks of t; a row within half a window of a border is copied to the
    # neighbouring block, so a long series is cut into pieces and no row is multiplied by the period.
    size = max(DECOMPOSE_BLOCK, 2 * n_win)
    block = lambda v: F.floor(v / F.lit(size))
    cut = x.withColumn("_block", F.explode(F.array_distinct(F.array(
        block(F.col("t")), block(F.col("t") - h), block(F.col("t") + h)))))
    near = Window.partitionBy(*series, "_block").orderBy("t").rangeBetween(-h, h)
    total = F.sum("y").over(near)
    if period % 2 == 0:  # the two ends of an even period weigh half
        total = total - 0.5 * F.first("y").over(near) - 0.5 * F.last("y").over(near)
    trend = F.when(F.count("y").over(near) == n_win, total / F.lit(float(period)))
    j = cut.withColumn("trend", trend).filter(F.col("_block") == block(F.col("t"))).drop("_block") \
        .withColumn("detrended", F.col("y") - F.col("trend")).withColumn("phase", F.pmod(F.col("t"), F.lit(period)))
    ph = j.groupBy(*series, "phase").agg(F.avg("detrended").alias("_pm"))
    w = Window.partitionBy(*series) if series else Window.partitionBy()
    ph = ph.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(w)).drop("_pm")
    out = attach(j, ph, [*series, "phase"], known_rows=None)
    return out.select(*series, "t", F.col("y").alias("observed"), "trend", "seasonal",
                      (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid"))


# ---------------------------------------------------------------- periodicity

FFT_POINTS_PER_GROUP = 1 << 20


def _split(n: int) -> int:
    """Largest divisor of n not above √n (1 when n is prime)."""
    for d in range(int(n ** 0.5), 1, -1):
        if n % d == 0:
            return d
    return 1


def dft_power(regular: DataFrame, series: Sequence[str] | None = None, t: str = "t",
              value: str = "value", max_class_points: int = FFT_POINTS_PER_GROUP) -> DataFrame:
    """Power ``|Σ (y−ȳ)·e^{−2πikt/n}|²`` for bins k = 1 … n//2 − 1: ``(series..., n, k, frequency, period, power)``.

    A distributed four-step FFT for every length n = n1·n2 (n1 the largest divisor ≤ √n):
    FFTs of length n1 over the residue classes ``t mod n2``, a twiddle factor, then FFTs of
    length n2 over the output classes k1; classes are batched into ``applyInPandas`` groups
    of about 2²⁰ points and transformed by one vectorised NumPy call per group. A length
    whose split leaves more than ``max_class_points`` points in one class (a large prime,
    say) goes through Bluestein's chirp-z transform on a power of two instead. The split is
    computed next to each series' length, so neither their number nor their lengths matter.
    """
    series = as_list(series)
    x = materialize(regular.select(*series, F.col(t).alias("t"), F.col(value).cast("double").alias("y")))  # read for its size and mean, then transformed
    st = x.groupBy(*series).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("_m"))
    st = st.filter(F.col("n") >= MIN_FFT_POINTS)
    j = attach(x, st, series, known_rows=None) if series else x.crossJoin(F.broadcast(st))
    return _fft_power(j, series, materialize(_plan_fft(st, series, max_class_points)))


def _plan_fft(st: DataFrame, series: list[str], max_class_points: int) -> DataFrame:
    """``(series..., _mode, _L, _n1, _n2)``: each series' transform length and its split."""
    @F.pandas_udf("array<long>")
    def lengths(n):
        def one(n: int) -> list[int]:
            n1 = _split(n)
            if n // n1 <= max_class_points:
                return [0, n, n1, n // n1]
            m = 1 << (2 * n - 2).bit_length()
            m1 = 1 << ((m.bit_length() - 1) // 2)
            return [1, m, m1, m // m1]
        return n.map(lambda v: one(int(v)))

    p = st.select(*series, lengths(F.col("n").cast("long")).alias("_p"))
    return p.select(*series, F.when(F.col("_p")[0] == 0, "direct").otherwise("bluestein").alias("_mode"),
                    F.col("_p")[1].alias("_L"), F.col("_p")[2].alias("_n1"), F.col("_p")[3].alias("_n2"))


def _four_step(x: DataFrame, series: list[str], inverse: bool = False) -> DataFrame:
    """Distributed FFT of length ``_L = _n1·_n2`` per series over ``(series..., _L, _n1, _n2, t, re, im)``
    (absent indices are zeros). Returns ``(series..., _L, k, re, im)``; ``inverse`` includes 1/L.

    Residue classes ``t mod _n2`` get length-n1 FFTs and a twiddle, then output classes k1
    get length-n2 FFTs; classes are batched into groups of about ``FFT_POINTS_PER_GROUP``
    points and transformed by one vectorised NumPy call per group."""
    import numpy as np
    import pandas as pd

    from tablens.session import ship_package
    ship_package(x.sparkSession)
    sgn = -1.0 if inverse else 1.0
    x = x.select(*series, "_L", "_n1", "_n2", "re", (F.col("im") * sgn).alias("im"),
                 (F.col("t") % F.col("_n2")).alias("t2"), F.floor(F.col("t") / F.col("_n2")).alias("t1"))
    x = x.withColumn("_ga", F.col("t2") % F.greatest(F.lit(1), F.floor(F.col("_L") / FFT_POINTS_PER_GROUP)))
    sk = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.select(*series).schema.fields)
    sk = sk + ", " if sk else ""

    def head(pdf, m):
        return pd.DataFrame({c: [pdf[c].iloc[0]] * m for c in series}, index=range(m))

    def step_a(pdf: pd.DataFrame) -> pd.DataFrame:
        L, n1, n2 = (int(pdf[c].iloc[0]) for c in ("_L", "_n1", "_n2"))
        cls, inv = np.unique(pdf["t2"].to_numpy(), return_inverse=True)
        mat = np.zeros((len(cls), n1), dtype=complex)
        mat[inv, pdf["t1"].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        k1 = np.arange(n1)
        a = np.fft.fft(mat, axis=1) * np.exp(-2j * np.pi * np.outer(cls, k1) / L)
        return head(pdf, a.size).assign(_L=L, _n1=n1, _n2=n2, k1=np.tile(k1, len(cls)), t2=np.repeat(cls, n1),
                                        re=a.real.ravel(), im=a.imag.ravel())

    a = x.groupBy(*series, "_ga").applyInPandas(
        step_a, f"{sk}_L long, _n1 long, _n2 long, k1 long, t2 long, re double, im double")
    a = a.withColumn("_gb", F.col("k1") % F.greatest(F.lit(1), F.floor(F.col("_L") / FFT_POINTS_PER_GROUP)))

    def step_b(pdf: pd.DataFrame) -> pd.DataFrame:
        L, n1, n2 = (int(pdf[c].iloc[0]) for c in ("_L", "_n1", "_n2"))
        cls, inv = np.unique(pdf["k1"].to_numpy(), return_inverse=True)
        mat = np.zeros((len(cls), n2), dtype=complex)
        mat[inv, pdf["t2"].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        xk = np.fft.fft(mat, axis=1)
        if inverse:
            xk = np.conj(xk) / L
        k = (cls[:, None] + n1 * np.arange(n2)[None, :]).ravel()
        return head(pdf, xk.size).assign(_L=L, k=k, re=xk.real.ravel(), im=xk.imag.ravel())

    return a.groupBy(*series, "_gb").applyInPandas(step_b, f"{sk}_L long, k long, re double, im double")


def _fft_power(j: DataFrame, series: list[str], plan: DataFrame) -> DataFrame:
    """|X_k|² for k = 1 … n//2 − 1 of the demeaned series, direct or via Bluestein."""
    j = j.select(*series, "n", "t", (F.col("y") - F.col("_m")).alias("yc"))
    j = attach(j, plan, series, known_rows=None) if series else j.crossJoin(F.broadcast(plan))
    keep = (F.col("k") >= 1) & (F.col("k") <= F.floor(F.col("n") / 2) - 1)
    ns = j.select(*series, "n").distinct()

    direct = j.filter(F.col("_mode") == "direct").select(*series, "_L", "_n1", "_n2", "t",
                                                         F.col("yc").alias("re"), F.lit(0.0).alias("im"))
    modes = {r[0] for r in plan.select("_mode").distinct().collect()}
    d = _four_step(direct, series).withColumn("n", F.col("_L"))
    if "bluestein" not in modes:  # no length needs the chirp-z branch
        return _power_columns(d.filter(keep), series)

    # Bluestein: X_k = w*_k · Σ_t (y_t w*_t) w_{k−t}, w_j = e^{iπj²/n}; |X_k|² = |(a ⊛ b)_k|²
    blu = j.filter(F.col("_mode") == "bluestein")
    ph = F.lit(3.141592653589793) * ((F.col("t") * F.col("t")) % (2 * F.col("n"))) / F.col("n")
    a = blu.select(*series, "_L", "_n1", "_n2", "t", (F.col("yc") * F.cos(ph)).alias("re"),
                   (-F.col("yc") * F.sin(ph)).alias("im"))
    bl = blu.select(*series, "n", "_L", "_n1", "_n2").distinct() \
        .withColumn("_lo", F.lit(0).cast("long")).withColumn("_hi", F.col("n") - 1)
    bj = _chunked_range(bl, "_lo", "_hi", "j", series)
    phj = F.lit(3.141592653589793) * ((F.col("j") * F.col("j")) % (2 * F.col("n"))) / F.col("n")
    b = bj.select(*series, "_L", "_n1", "_n2", F.explode(F.array(
        F.struct(F.col("j").alias("t"), F.cos(phj).alias("re"), F.sin(phj).alias("im")),
        F.struct(F.when(F.col("j") > 0, F.col("_L") - F.col("j")).alias("t"), F.cos(phj).alias("re"),
                 F.sin(phj).alias("im")))).alias("_b")).select(*series, "_L", "_n1", "_n2", "_b.*") \
        .filter(F.col("t").isNotNull())
    fa = _four_step(a, series).select(*series, "_L", "k", F.col("re").alias("ar"), F.col("im").alias("ai"))
    fb = _four_step(b, series).select(*series, "_L", "k", F.col("re").alias("br"), F.col("im").alias("bi"))
    prod = fa.join(fb, [*series, "_L", "k"]).select(
        *series, "_L", F.col("k").alias("t"),
        (F.col("ar") * F.col("br") - F.col("ai") * F.col("bi")).alias("re"),
        (F.col("ar") * F.col("bi") + F.col("ai") * F.col("br")).alias("im"))
    prod = attach(prod, plan.select(*series, "_L", "_n1", "_n2"), [*series, "_L"], known_rows=None)
    conv = _four_step(prod, series, inverse=True)
    conv = attach(conv, ns, series, known_rows=None) if series else conv.crossJoin(F.broadcast(ns))
    out = d.unionByName(conv.select(*series, "_L", "k", "re", "im", "n"))
    return _power_columns(out.filter(keep), series)


def _power_columns(x: DataFrame, series: list[str]) -> DataFrame:
    return x.select(*series, "n", "k", (F.col("k") / F.col("n")).alias("frequency"), (F.col("n") / F.col("k")).alias("period"),
                    (F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("power"))


def dominant_periods(regular: DataFrame, series: Sequence[str] | None = None, t: str = "t",
                     value: str = "value", top: int | None = None, order: str = "frequency") -> DataFrame:
    """Bins whose power exceeds the 95th percentile of bins 1 … n//2 − 1.

    ``top`` keeps the first ``top`` bins by frequency (``order='frequency'``) or by
    power (``order='power'``).
    """
    series = as_list(series)
    p = materialize(dft_power(regular, series, t, value))  # the quantile reads it several times
    thr = quantile_table(p.select(*series, F.col("power").alias("value")), series,
                         {"threshold": FFT_POWER_PERCENTILE}).drop("n")
    d = (attach(p, thr, series, known_rows=None) if series else p.crossJoin(F.broadcast(thr))) \
        .filter(F.col("power") > F.col("threshold"))
    if top:
        okey = F.col("k") if order == "frequency" else F.desc("power")
        w = Window.partitionBy(*series).orderBy(okey, "k") if series else Window.orderBy(okey, "k")
        d = d.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= top).drop("_r")
    return d.select(*series, "k", "frequency", "period", "power", "threshold")
