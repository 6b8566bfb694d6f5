"""Standard normal tail and quantile as column expressions.

Spark has no ``erfc``; these use published rational approximations (Cody 1969
for the tail, Acklam for the quantile) so they stay inside generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cody's erfc coefficients, three ranges of |x|.
_NEAR_NUM = (1.85777706184603153e-1, 3.16112374387056560e00, 1.13864154151050156e02,
             3.77485237685302021e02, 3.20937758913846947e03)
_NEAR_DEN = (1.0, 2.36012909523441209e01, 2.44024637934444173e02,
             1.28261652607737228e03, 2.84423683343917062e03)
_MID_NUM = (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0,
            6.61191906371416295e01, 2.98635138197400131e02, 8.81952221241769090e02,
            1.71204761263407058e03, 2.05107837782607147e03, 1.23033935479799725e03)
_MID_DEN = (1.0, 1.57449261107098347e01, 1.17693950891312499e02, 5.37181101862009858e02,
            1.62138957456669019e03, 3.29079923573345963e03, 4.36261909014324716e03,
            3.43936767414372164e03, 1.23033935480374942e03)
_FAR_NUM = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1,
            1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4)
_FAR_DEN = (1.0, 2.56852019228982242e00, 1.87295284992346725e00,
            5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3)

# Acklam's normal quantile coefficients.
_PPF_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
          1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_PPF_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
          6.680131188771972e01, -1.328068155288572e01, 1.0)
_PPF_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
          -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_PPF_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
          3.754408661907416e00, 1.0)


_SQRT2 = math.sqrt(2.0)
_INV_SQRT_PI = 1.0 / math.sqrt(math.pi)
_LOW = 0.02425


def _poly(x: Column, coefficients) -> Column:
    """Horner form of a polynomial, highest power first."""
    out = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        out = out * x + F.lit(float(c))
    return out


def normal_sf(z: str) -> Column:
    """One-sided p-value P(Z > z) of the score held in column ``z``."""
    z_ = F.col(z)
    a = F.abs(z_) / _SQRT2
    sq = z_ * z_ / 2.0
    inv = 2.0 / F.greatest(z_ * z_, F.lit(1e-12))
    near = 1.0 - a * _poly(sq, _NEAR_NUM) / _poly(sq, _NEAR_DEN)
    mid = F.exp(-sq) * _poly(a, _MID_NUM) / _poly(a, _MID_DEN)
    far = F.exp(-sq) * (_INV_SQRT_PI - inv * _poly(inv, _FAR_NUM) / _poly(inv, _FAR_DEN)) / F.greatest(
        a, F.lit(1e-6))
    upper = F.when(a <= 0.46875, near).when(a <= 4.0, mid).otherwise(far)
    # 0.5*erfc(|x|) for z >= 0 and its complement below, with one copy of the tail.
    sign = F.when(z_ >= 0, 1.0).otherwise(-1.0)
    offset = F.when(z_ >= 0, 0.0).otherwise(1.0)
    return offset + sign * (0.5 * upper)


def normal_ppf(p: str) -> Column:
    """Normal quantile of the probability held in column ``p``."""
    p_ = F.col(p)
    c = p_ - 0.5
    tail = F.sqrt(-2.0 * F.ln(F.least(p_, 1.0 - p_)))
    end = _poly(tail, _PPF_C) / _poly(tail, _PPF_D)
    centre = c * _poly(c * c, _PPF_A) / _poly(c * c, _PPF_B)
    return (
        F.when((p_ <= 0) | (p_ >= 1), F.lit(None).cast("double"))
        .when(F.abs(c) > 0.5 - _LOW, F.when(c < 0, end).otherwise(-end)).otherwise(centre)
    )


def expected_max_z(n: int) -> float:
    """Expected maximum of n null z scores, approximated by a quantile."""
    from statistics import NormalDist

    return NormalDist().inv_cdf(1.0 - 1.0 / max(int(n), 2))


def normal_sf_sql(z: str) -> str:
    """The same tail as SQL text, for engines that compare results."""

    def poly(x: str, coefficients) -> str:
        out = repr(float(coefficients[0]))
        for c in coefficients[1:]:
            out = f"({out} * {x} + {c!r})"
        return out

    a = f"(abs({z}) / {_SQRT2!r})"
    sq = f"(({z}) * ({z}) / 2.0)"
    inv = f"(2.0 / greatest(({z}) * ({z}), 1e-12))"
    near = f"1.0 - {a} * {poly(sq, _NEAR_NUM)} / {poly(sq, _NEAR_DEN)}"
    mid = f"exp(-{sq}) * {poly(a, _MID_NUM)} / {poly(a, _MID_DEN)}"
    far = (f"exp(-{sq}) * ({_INV_SQRT_PI!r} - {inv} * {poly(inv, _FAR_NUM)} / {poly(inv, _FAR_DEN)})"
           f" / greatest({a}, 1e-6)")
    upper = f"(CASE WHEN {a} <= 0.46875 THEN {near} WHEN {a} <= 4.0 THEN {mid} ELSE {far} END)"
    return f"(CASE WHEN ({z}) >= 0 THEN 0.5 * {upper} ELSE 1.0 - 0.5 * {upper} END)"
