"""Chi-squared distribution helpers for the one-row-per-test finish.

The contingency table and the statistic are Spark aggregates; only the
distribution function (no Spark SQL built-in exists) is evaluated here, on the
final rows, through an Arrow-batched pandas UDF.  The functions are the
regularised incomplete gamma function (series below a+1, Lentz continued
fraction above), as in any numerical-methods text.
"""

from __future__ import annotations

import itertools
import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
# From this many degrees of freedom the Wilson-Hilferty normal approximation is used (error below 1e-7).
_LARGE_DOF = 100_000


def _gamma_p_series(a: float, x: float) -> float:
    term = total = 1.0 / a
    ap = a
    while True:
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * _EPS:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_q_fraction(a: float, x: float) -> float:
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in itertools.count(1):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, dof: float) -> float:
    """P(X >= x) for X ~ chi-squared(dof); 1.0 for dof <= 0 or x <= 0."""
    if x is None or dof is None or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    if dof <= 0:
        return float("nan") if dof < 0 else 1.0
    if x <= 0:
        return 1.0
    if dof > _LARGE_DOF:
        v = 2.0 / (9.0 * dof)
        return 0.5 * math.erfc(((x / dof) ** (1.0 / 3.0) - (1.0 - v)) / math.sqrt(2.0 * v))
    a, y = dof / 2.0, x / 2.0
    if y < a + 1.0:
        return max(0.0, 1.0 - _gamma_p_series(a, y))
    return _gamma_q_fraction(a, y)


def chi2_ppf(prob: float, dof: float) -> float:
    """Quantile: the x with P(X <= x) = prob, by bisection on :func:`chi2_sf`."""
    if dof <= 0:
        return float("nan")
    target = 1.0 - prob
    lo, hi = 0.0, max(1.0, dof)
    while chi2_sf(hi, dof) > target:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if chi2_sf(mid, dof) > target:
            lo = mid
        else:
            hi = mid
        if hi - lo <= 1e-12 * max(1.0, hi):
            break
    return 0.5 * (lo + hi)


@F.pandas_udf(T.StructType([T.StructField("critical", T.DoubleType()), T.StructField("p", T.DoubleType())]))
def chi2_finish_udf(stat: pd.Series, dof: pd.Series, prob: pd.Series) -> pd.DataFrame:
    """Critical value at ``prob`` and p-value of ``stat``, one Arrow batch of test rows."""
    return pd.DataFrame({"critical": [chi2_ppf(float(q), float(d)) for q, d in zip(prob, dof)],
                         "p": [chi2_sf(float(s), float(d)) for s, d in zip(stat, dof)]})
