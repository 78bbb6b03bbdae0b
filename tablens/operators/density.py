"""Kernel density on a grid, multimodality, histograms.

The KDE never pairs every row with every grid point: rows first collapse to
distinct values with weights (map-side combined), and each value only feeds the
grid points within ``TRUNCATE_SD`` bandwidths, beyond which a Gaussian term is
below 1.3e-14 of its peak. Every grid point is listed, whether or not a value is
near it. The grid is generated per column from indices, so nothing is broadcast
and nothing grows on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, long_form, numeric_columns
from tablens.functions.joins import attach
from tablens.functions.quantiles import quantile_table

# Grid size and minimum sample of the multimodality test.
GRID_POINTS = 1000
MIN_KDE_ROWS = 100
TRUNCATE_SD = 8.0
SQRT_2PI = 2.5066282746310002


def kde_grid(df: DataFrame, columns: Sequence[str] | None = None, group=None, grid_points: int = GRID_POINTS,
             min_rows: int = 1) -> DataFrame:
    """Gaussian KDE (Scott bandwidth ``std_samp · n^(−1/5)``) on ``grid_points`` equally spaced
    points from min to max: ``(group..., column_name, i, x, density)``."""
    group = as_list(group)
    columns = as_list(columns) or numeric_columns(df, exclude=group)
    base = df
    for g in group:
        base = base.filter(F.col(g).isNotNull())
    lf = long_form(base, columns, ids=group, variable="column_name")
    keys = group + ["column_name"]
    st = lf.groupBy(*keys).agg(F.count("value").alias("n"), F.min("value").alias("lo"),
                               F.max("value").alias("hi"), F.stddev_samp("value").alias("sd"))
    st = st.filter((F.col("n") >= F.lit(min_rows)) & (F.col("hi") > F.col("lo")) & (F.col("sd") > 0))
    st = st.withColumn("h", F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))) \
           .withColumn("dx", (F.col("hi") - F.col("lo")) / F.lit(grid_points - 1))
    w = lf.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("w"))
    j = attach(w, st, keys, known_rows=None)
    reach = F.lit(TRUNCATE_SD) * F.col("h")
    i0 = F.greatest(F.lit(0), F.ceil((F.col("value") - reach - F.col("lo")) / F.col("dx")))
    i1 = F.least(F.lit(grid_points - 1), F.floor((F.col("value") + reach - F.col("lo")) / F.col("dx")))
    j = j.withColumn("_i0", i0.cast("int")).withColumn("_i1", i1.cast("int")).filter(F.col("_i1") >= F.col("_i0"))
    pts = j.select(*keys, "value", "w", "n", "h", "lo", "dx", F.explode(F.sequence("_i0", "_i1")).alias("i"))
    x = F.col("lo") + F.col("i") * F.col("dx")
    z = (x - F.col("value")) / F.col("h")
    dens = pts.groupBy(*keys, "i").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("_s"))
    every = st.select(*keys, "n", "h", "lo", "dx", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("i"))
    grid = every.join(dens, [*keys, "i"], "left")
    grid_x = F.when(F.col("i") == grid_points - 1, F.col("lo") + F.col("dx") * (grid_points - 1)).otherwise(
        F.col("lo") + F.col("i") * F.col("dx"))
    return grid.select(*keys, "i", grid_x.alias("x"),
                       (F.coalesce("_s", F.lit(0.0)) / (F.col("n") * F.col("h") * F.lit(SQRT_2PI))).alias("density"))


def kde_modes(df: DataFrame, columns: Sequence[str] | None = None, group=None, grid_points: int = GRID_POINTS,
              min_rows: int = MIN_KDE_ROWS, multimodal_only: bool = False) -> DataFrame:
    """Strict local maxima of the grid density (ends excluded): ``(…, column_name, i, x, density, mode_count)``.

    Columns with fewer than ``min_rows`` values are skipped. ``multimodal_only`` keeps
    columns with at least two modes. The lag/lead window spans one column's 1000-point
    grid, a bounded partition.
    """
    group = as_list(group)
    keys = group + ["column_name"]
    g = kde_grid(df, columns, group, grid_points, min_rows)
    w = Window.partitionBy(*keys).orderBy("i")
    peaks = g.withColumn("_prev", F.lag("density").over(w)).withColumn("_next", F.lead("density").over(w)) \
        .filter((F.col("density") > F.col("_prev")) & (F.col("density") > F.col("_next")))
    peaks = peaks.withColumn("mode_count", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    if multimodal_only:
        peaks = peaks.filter(F.col("mode_count") >= 2)
    return peaks.select(*keys, "i", "x", "density", "mode_count")


# Automatic bins of a column (of a group); far values would ask for millions.
MAX_BINS = 10_000


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int | str = "auto",
              group=None) -> DataFrame:
    """Histogram counts per column: ``(group..., column_name, bin, lower, upper, count)``.

    ``bins='auto'``: the narrower of the Sturges and Freedman–Diaconis widths (the
    latter only when IQR > 0), ``ceil(range / width)`` bins; the maximum value falls
    in the last bin. Empty bins are listed with count 0. There are at most ``MAX_BINS`` bins: where far values
    ask for more, all bins are widened alike. Infinite values are left out.
    """
    group = as_list(group)
    columns = as_list(columns) or numeric_columns(df, exclude=group)
    lf = long_form(df, columns, ids=group, variable="column_name").where(F.abs("value") < float("inf"))
    keys = group + ["column_name"]
    st = lf.groupBy(*keys).agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    if bins == "auto":
        q = quantile_table(lf, keys, {"q1": 0.25, "q3": 0.75}).drop("n")
        st = st.join(q, keys, "left")
        rng = F.col("hi") - F.col("lo")
        sturges = rng / (F.log2(F.col("n")) + 1)
        fd = 2.0 * (F.col("q3") - F.col("q1")) * F.pow(F.col("n"), F.lit(-1.0 / 3.0))
        width = F.when(fd > 0, F.least(sturges, fd)).otherwise(sturges)
        nb = F.when(rng > 0, F.ceil(F.greatest(F.lit(1.0), F.least(rng / width, F.lit(float(MAX_BINS)))))).otherwise(F.lit(1))
        st = st.withColumn("nbins", nb.cast("int")).drop("q1", "q3")
    else:
        st = st.withColumn("nbins", F.lit(int(bins)))
    j = attach(lf, st, keys, known_rows=None)
    rng = F.col("hi") - F.col("lo")
    b = F.when(rng == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / rng * F.col("nbins")), F.col("nbins") - 1))
    h = j.withColumn("bin", b.cast("int")).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"))
    every = st.select(*keys, "lo", "hi", "nbins", F.explode(F.sequence(F.lit(0), F.col("nbins") - 1)).alias("bin"))
    match = F.lit(True)
    for k in [*keys, "bin"]:
        h = h.withColumnRenamed(k, f"_h_{k}")
        match = match & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / F.col("nbins")).otherwise(F.lit(0.0))
    return every.join(h, match, "left").select(
        *keys, "bin", (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"), F.coalesce("count", F.lit(0)).cast("long").alias("count"))
