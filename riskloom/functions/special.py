"""Tail probabilities of the drift tests.

The Kolmogorov tail is a Column expression. The chi-square tail and the exact tail for small
samples are evaluated on one row per tested feature only, through small vector helpers.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def kolmogorov_tail(lam: Column, terms: int = 100) -> Column:
    """P(K > lam) = 2 sum (-1)^(k-1) exp(-2 k^2 lam^2), clamped to [0, 1]; 1 below 0.2."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


def chi_square_tail(x: float, dof: float) -> float:
    """Upper regularised incomplete gamma Q(dof/2, x/2): power series below a+1, else Lentz fraction."""
    if dof <= 0 or x is None or math.isnan(x):
        return float("nan")
    if x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    front = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= z / n
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = z + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return min(1.0, front * h)


@F.pandas_udf(DoubleType())
def chi_square_tail_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) else chi_square_tail(float(a), float(b)) for a, b in zip(x, dof)])


def exact_ks_tail(n_ref: int, n_cur: int, d: float) -> float:
    """P(D >= d) when both samples come from one distribution without ties.

    A random interleaving of the samples is a lattice path; the share of paths that ever reach a
    gap of ``d`` is carried along the anti-diagonals. Gaps are compared as whole numbers.
    """
    limit = round(d * n_ref * n_cur)
    if limit <= 0:
        return 1.0
    i = np.arange(n_ref + 1, dtype="float64")
    reached = np.zeros(n_ref + 1)
    for t in range(1, n_ref + n_cur + 1):
        step = np.empty_like(reached)
        step[0] = reached[0]
        step[1:] = (i[1:] * reached[:-1] + (t - i[1:]) * reached[1:]) / t
        j = t - i
        step[np.abs(i * n_cur - j * n_ref) >= limit - 0.5] = 1.0
        step[(j < 0) | (j > n_cur)] = 0.0
        reached = step
    return float(min(1.0, max(0.0, reached[n_ref])))


@F.pandas_udf(DoubleType())
def exact_ks_tail_udf(n_ref: pd.Series, n_cur: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) else exact_ks_tail(int(a), int(b), float(x)) for a, b, x in zip(n_ref, n_cur, d)])
