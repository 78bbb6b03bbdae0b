"""Column-expression helpers for the numeric conventions the operators share.

All helpers return ``Column`` expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)

# Validity rules and limits the reference applies.
RATIO_EPSILON = 1e-9                    # epsilon added to ratio denominators
NUMERIC_TEXT_PATTERN = r"^\s*[+-]?((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?\s*$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """Missing model: NaN is treated as NULL (Spark sorts NaN as the largest value)."""
    c = col_(c)
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def missing_to_null(df, columns):
    """``df`` with NaN read as NULL in those of ``columns`` that hold floating-point numbers; types stay."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(kinds[c])) for c in columns
                           if kinds.get(c) in ("double", "float")})


def safe_div(a, b) -> Column:
    """Division that yields NULL instead of raising on a zero divisor (ANSI mode)."""
    return F.try_divide(col_(a).cast("double"), col_(b).cast("double"))


def ratio(a, b, epsilon: float | None = None) -> Column:
    """``a / b`` or ``a / (b + epsilon)``; zero divisor → NULL."""
    den = col_(b).cast("double")
    if epsilon:
        den = den + F.lit(float(epsilon))
    return safe_div(a, den)


def ratio_below(a, b, limit: float) -> Column:
    """Predicate ``a / b < limit`` with IEEE outcomes spelled out.

    +inf, NaN and missing give False; a negative numerator over zero (-inf) gives True.
    """
    a, b = col_(a).cast("double"), col_(b).cast("double")
    return (F.when(a.isNull() | b.isNull() | F.isnan(a) | F.isnan(b), F.lit(False))
             .when(b == 0, a < 0)
             .otherwise(a / b < F.lit(float(limit))))


def round_half_even(c, digits: int = 0) -> Column:
    return F.bround(col_(c), digits)


def safe_corr(a, b) -> Column:
    """Pearson correlation over pairwise-complete rows; NULL on zero spread.

    ``corr`` raises DIVIDE_BY_ZERO on a constant input under ANSI mode, so it is
    computed from population moments with ``try_divide``.
    """
    a, b = nan_to_null(a), nan_to_null(b)
    both = a.isNotNull() & b.isNotNull()
    aa = F.when(both, a)
    bb = F.when(both, b)
    return F.try_divide(F.covar_pop(aa, bb), F.sqrt(F.var_pop(aa) * F.var_pop(bb)))


def is_numeric_text(c) -> Column:
    """True if the text is a plain decimal/scientific number (no Java suffixes like '1d')."""
    return col_(c).rlike(NUMERIC_TEXT_PATTERN)


def to_number(c) -> Column:
    """Coerce text to double, junk → NULL, 'NaN' → NULL (``errors='coerce'`` semantics)."""
    c = col_(c)
    return F.when(is_numeric_text(c.cast("string")), nan_to_null(c.cast("string").try_cast("double")))


# Coefficients of Acklam's rational approximation of the normal quantile.
_ACKLAM_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
             1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_ACKLAM_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
             6.680131188771972e+01, -1.328068155288572e+01]
_ACKLAM_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
             -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_ACKLAM_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
             3.754408661907416e+00]


def inv_norm_cdf(p) -> Column:
    """Rational approximation of the standard normal quantile Φ⁻¹(p), 0 < p < 1.

    Acklam's algorithm (relative error < 1.2e-9), written as one column expression.
    """
    p = col_(p)
    a, b, c, d = _ACKLAM_A, _ACKLAM_B, _ACKLAM_C, _ACKLAM_D
    plow = 0.02425

    def poly(coefs, x):
        acc = F.lit(coefs[0])
        for k in coefs[1:]:
            acc = acc * x + F.lit(k)
        return acc

    q_low = F.sqrt(-2 * F.log(p))
    low = poly(c, q_low) / (poly(d, q_low) * q_low + 1)
    q_high = F.sqrt(-2 * F.log(1 - p))
    high = -poly(c, q_high) / (poly(d, q_high) * q_high + 1)
    q = p - 0.5
    r = q * q
    mid = poly(a, r) * q / (poly(b, r) * r + 1)
    return F.when(p < plow, low).when(p > 1 - plow, high).otherwise(mid)


def inv_norm_cdf_sql(p: str) -> str:
    """The same approximation as DuckDB/ANSI SQL text (used by oracles and tests)."""
    a, b, c, d = _ACKLAM_A, _ACKLAM_B, _ACKLAM_C, _ACKLAM_D

    def poly(coefs, x):
        acc = repr(coefs[0])
        for k in coefs[1:]:
            acc = f"(({acc}) * ({x}) + {k!r})"
        return acc

    ql = f"sqrt(-2 * ln({p}))"
    qh = f"sqrt(-2 * ln(1 - ({p})))"
    q = f"(({p}) - 0.5)"
    r = f"({q} * {q})"
    return (f"(case when ({p}) < 0.02425 then {poly(c, ql)} / ({poly(d, ql)} * {ql} + 1) "
            f"when ({p}) > 1 - 0.02425 then -{poly(c, qh)} / ({poly(d, qh)} * {qh} + 1) "
            f"else {poly(a, r)} * {q} / ({poly(b, r)} * {r} + 1) end)")


# West's coefficients of the cumulative normal (numerator, denominator).
_WEST_A = [3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376]
_WEST_B = [8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948,
           440.413735824752]
_WEST_FAR = 7.07106781186547


def norm_cdf(z) -> Column:
    """The standard normal distribution function Φ(z) to about 1e-15, as one column expression."""
    z = col_(z)
    x = F.abs(z)

    def poly(coefs):
        acc = F.lit(coefs[0])
        for k in coefs[1:]:
            acc = acc * x + F.lit(k)
        return acc

    tail = F.exp(-x * x / 2)
    near = tail * poly(_WEST_A) / poly(_WEST_B)
    far = tail / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65))))) / 2.506628274631
    upper = F.when(x > 37, F.lit(0.0)).when(x < _WEST_FAR, near).otherwise(far)
    return F.when(z > 0, 1 - upper).otherwise(upper)


def norm_cdf_sql(z: str) -> str:
    """The same function as SQL text; ``z`` is a column name."""
    x = f"abs({z})"

    def poly(coefs):
        acc = repr(coefs[0])
        for k in coefs[1:]:
            acc = f"({acc} * {x} + {k!r})"
        return acc

    far = f"exp(-{x} * {x} / 2) / ({x} + 1 / ({x} + 2 / ({x} + 3 / ({x} + 4 / ({x} + 0.65))))) / 2.506628274631"
    upper = f"(case when {x} > 37 then 0.0::double when {x} < {_WEST_FAR} then exp(-{x} * {x} / 2) * {poly(_WEST_A)} / {poly(_WEST_B)} else {far} end)"
    return f"(case when {z} > 0 then 1 - {upper} else {upper} end)"


def kolmogorov_sf(x) -> Column:
    """The probability that the Kolmogorov distribution exceeds ``x`` (limit for large samples), to about 1e-12."""
    x = col_(x)
    # Two series: that for small x converges where the other does not.
    small = 1 - F.lit(2.5066282746310002) / x * sum((F.exp(F.lit(-((2 * k - 1) ** 2) * 9.869604401089358 / 8) / (x * x)) for k in range(1, 5)), F.lit(0.0))
    large = 2 * sum(((1 if k % 2 else -1) * F.exp(F.lit(-2.0 * k * k) * x * x) for k in range(1, 7)), F.lit(0.0))
    return F.when(x <= 0, F.lit(1.0)).when(x < 1.18, small).otherwise(large)


def kolmogorov_sf_sql(x: str) -> str:
    """The same probability as SQL text; ``x`` is a column name."""
    small = "1 - 2.5066282746310002 / {x} * (" + " + ".join(f"exp({-((2 * k - 1) ** 2) * 9.869604401089358 / 8!r} / ({{x}} * {{x}}))" for k in range(1, 5)) + ")"
    large = "2 * (" + " + ".join(f"({1 if k % 2 else -1}) * exp({-2.0 * k * k!r} * {{x}} * {{x}})" for k in range(1, 7)) + ")"
    return f"(case when {x} <= 0 then 1.0 when {x} < 1.18 then {small.format(x=x)} else {large.format(x=x)} end)"
