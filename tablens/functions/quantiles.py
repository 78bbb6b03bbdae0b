"""Exact (linear-interpolated) and approximate quantiles over a long table.

Spark's exact ``percentile`` aggregate keeps every distinct value of a group in one final task, which
does not hold when one group has a third of 100 TB. Here the order statistics are found by radix
selection, the same way at every size:

* a double becomes a signed 64-bit key in the same order (its IEEE bits, inverted below zero), computed by
  exact arithmetic with powers of two, inside whole-stage code;
* each of three rounds counts the next 16, 24 and 24 bits of the keys per group, map-side combined: at most
  65,536 counts per group and task leave the first scan, whatever the values. A running count finds the
  digit in which each wanted rank lies, and its rank within;
* later rounds count only the values that share all digits found so far, so that their scans
  shuffle little (at most 2^24 counts per group and digit, whatever the number of values); after the
  third the key is whole and is turned back into the value.

Each probability needs the two order statistics around ``h = p·(n − 1)``; interpolation as in
``percentile``/``quantile_cont``: ``v[k] + (h - k)·(v[k+1] - v[k])``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablens.functions.frames import as_list
from tablens.session import materialize

DEFAULT_ACCURACY = 10_000
# Bits of the key that are still open after each round.
OPEN_BITS = (48, 24, 0)
# Rows of (group, found digits) that are broadcast to a round's scan; more are joined by a shuffle.
MAX_BROADCAST_ROWS = 500_000
_INF = float("inf")
_MANTISSA = 1 << 52


def _prob_items(probs) -> list[tuple[str, float]]:
    if isinstance(probs, Mapping):
        return [(str(k), float(v)) for k, v in probs.items()]
    return [(f"p{int(round(float(p) * 100)):02d}", float(p)) for p in probs]


def with_ordered_key(df: DataFrame, value: str, key: str) -> DataFrame:
    """``df`` with a long ``key`` that orders like the double ``value`` (no NaN); -0.0 counts as 0.0."""
    a = F.abs(F.col(value))
    normal = (a >= 2.0**-1022) & (a < _INF)
    out = df.withColumn("_a", a).withColumn("_e", F.when(normal, F.least(F.floor(F.log2(a)), F.lit(1023))).cast("int"))
    out = out.withColumn("_p", F.pow(F.lit(2.0), F.col("_e")))
    # The logarithm is rounded: the exponent may be one off.
    out = out.withColumn("_off", F.when(F.col("_p") > F.col("_a"), -1).when(F.col("_p") * 2 <= F.col("_a"), 1).otherwise(0))
    part = F.col("_a") / F.col("_p") * F.when(F.col("_off") == -1, 2.0).when(F.col("_off") == 1, 0.5).otherwise(1.0) - 1
    whole = F.shiftleft((F.col("_e") + F.col("_off") + 1023).cast("long"), 52) + (part * float(_MANTISSA)).cast("long")
    tiny = (F.col("_a") * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    bits = F.when(F.col("_e").isNotNull(), whole).when(F.col("_a") == _INF, F.lit(2047 << 52)).otherwise(tiny)
    return out.withColumn(key, F.when(F.col(value) < 0, -1 - bits).otherwise(bits)).drop("_a", "_e", "_p", "_off")


def key_value(key: Column) -> Column:
    """The double of an ordered key."""
    bits = F.when(key < 0, -1 - key).otherwise(key)
    e, mantissa = F.shiftright(bits, 52).cast("int"), bits.bitwiseAND(F.lit(_MANTISSA - 1)).cast("double")
    a = (F.when(e == 2047, F.lit(_INF)).when(e == 0, mantissa * F.lit(2.0**-1074))
         .otherwise((mantissa / float(_MANTISSA) + 1) * F.pow(F.lit(2.0), e - 1023)))
    return F.when(key < 0, -a).otherwise(a)


def _match(left: DataFrame, right: DataFrame, on: Sequence[str], small: bool) -> DataFrame:
    """Inner join on null-safe equal ``on`` columns, ``right`` broadcast where it is ``small``."""
    names = {c: f"_right{i}" for i, c in enumerate(on)}
    right = right.withColumnsRenamed(names)
    cond = F.lit(True)
    for c, r in names.items():
        cond = cond & left[c].eqNullSafe(right[r])
    return left.join(F.broadcast(right) if small else right, cond).drop(*names.values())


def quantile_table(long: DataFrame, by: Sequence[str] | None, probs, value: str = "value",
                   method: str = "exact", accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Quantiles of ``value`` per ``by`` group: ``(by..., n, <name> for each prob)``.

    ``probs`` is a list of probabilities or a ``{name: p}`` mapping. NULL and NaN are
    ignored; groups without other values are absent. ``method='approx'`` returns
    ``percentile_approx`` results (one aggregate, bounded memory).
    """
    by = as_list(by)
    items = _prob_items(probs)
    # -0.0 + 0.0 is 0.0; NaN is missing.
    src = long.select(*by, (F.col(value).cast("double") + F.lit(0.0)).alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if method == "approx":
        agg = src.groupBy(*by).agg(
            F.count("_v").alias("n"),
            F.percentile_approx("_v", F.array(*[F.lit(p) for _, p in items]), accuracy).alias("_a"))
        return agg.select(*by, "n", *[F.col("_a")[i].alias(nm) for i, (nm, _) in enumerate(items)])
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")

    m = 2 * len(items)
    keyed = with_ordered_key(src, "_v", "_key").select(*by, "_key")
    digits = lambda r: F.shiftright("_key", OPEN_BITS[r])  # noqa: E731  all up to round r
    counts = keyed.groupBy(*by, digits(0).alias("_digits")).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*by).orderBy("_digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_n", F.sum("_c").over(Window.partitionBy(*by))).withColumn("_before", F.sum("_c").over(upto) - F.col("_c"))
    ranks = []
    for i, (_, p) in enumerate(items):
        k = F.floor(F.lit(p) * (F.col("_n") - 1)).cast("long")
        ranks += [F.struct(F.lit(2 * i).alias("_at"), k.alias("_rank")),
                  F.struct(F.lit(2 * i + 1).alias("_at"), F.least(k + 1, F.col("_n") - 1).alias("_rank"))]
    inside = F.filter(F.array(*ranks), lambda t: (t["_rank"] >= F.col("_before")) & (t["_rank"] < F.col("_before") + F.col("_c")))
    hit = counts.select(*by, "_n", "_digits", "_before", F.explode(inside).alias("_t"))
    wanted = materialize(hit.select(*by, "_n", "_digits", "_t._at", (F.col("_t._rank") - F.col("_before")).alias("_rank")))
    rows = wanted.count()
    small = rows <= MAX_BROADCAST_ROWS
    for r in range(1, len(OPEN_BITS)):
        found = wanted.select(*by, "_digits").distinct()
        near = _match(keyed.withColumn("_digits", digits(r - 1)), found, [*by, "_digits"], small)
        counts = near.groupBy(*by, "_digits", digits(r).alias("_next")).agg(F.count(F.lit(1)).alias("_c"))
        upto = Window.partitionBy(*by, "_digits").orderBy("_next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("_before", F.sum("_c").over(upto) - F.col("_c"))
        hit = _match(counts, wanted, [*by, "_digits"], small)
        hit = hit.where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c")))
        wanted = materialize(hit.select(*by, "_n", F.col("_next").alias("_digits"), "_at", (F.col("_rank") - F.col("_before")).alias("_rank")))
    wide = wanted.withColumn("_v", key_value(F.col("_digits"))).groupBy(*by).agg(
        F.max("_n").alias("n"), *[F.max(F.when(F.col("_at") == i, F.col("_v"))).alias(f"_v{i}") for i in range(m)])
    out = []
    for i, (name, p) in enumerate(items):
        h = F.lit(p) * (F.col("n") - 1)
        part = h - F.floor(h)
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        out.append(F.when((part == 0) | (low == high), low).otherwise(low + part * (high - low)).alias(name))
    result = wide.where(F.col("n").isNotNull()).select(*by, "n", *out)
    result._tablens_meta = {"rows": rows // m}
    return result


def median_table(long: DataFrame, by, value: str = "value", **kw) -> DataFrame:
    return quantile_table(long, by, {"median": 0.5}, value=value, **kw)


__all__ = ["quantile_table", "median_table", "with_ordered_key", "key_value"]
