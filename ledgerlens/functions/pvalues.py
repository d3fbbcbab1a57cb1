"""Tail probabilities of test statistics; each call handles a few numbers, never data."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Workers get these functions with the task and need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def chi_square(statistic: float, freedom: int) -> float:
    """P(X >= statistic) for a chi-square variable with whole degrees of freedom."""
    if freedom < 1:
        return 1.0
    if math.isinf(statistic):
        return 0.0
    half = statistic / 2
    if freedom % 2 == 0:
        term, total = 1.0, 1.0
        for i in range(1, freedom // 2):
            term *= half / i
            total += term
        return min(1.0, math.exp(-half) * total)
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for i in range(1, (freedom - 1) // 2 + 1):
        total += term
        term *= half / (i + 0.5)
    return min(1.0, total)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _ks_exact(distance: float, m: int, n: int) -> float:
    """P(D >= distance): one minus the chance that a random path stays inside the band.

    Walks the m x n grid row by row; within a row the reachable cells are contiguous
    and their chances are a running sum.
    """
    limit = (0.5 + math.floor(distance * m * n - 1e-7)) / (m * n)
    columns = np.arange(n + 1) / n
    inside = np.where(columns <= limit, 1.0, 0.0)
    for i in range(1, m + 1):
        reachable = np.abs(i / m - columns) <= limit
        inside = np.cumsum(np.where(reachable, inside * (i / (i + n)), 0.0)) * reachable
    return float(min(1.0, max(0.0, 1.0 - inside[n])))


def kolmogorov_smirnov(distance: float, m: int, n: int, exact: bool = False) -> float:
    """Two-sided p-value of the two-sample distance: the limiting series, or by all paths."""
    if min(m, n) == 0:
        return 1.0
    if exact:
        return _ks_exact(distance, min(m, n), max(m, n))
    x = distance * math.sqrt(m * n / (m + n))
    if x < 0.2:
        return 1.0
    series = sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * series))


def tail(test: str, statistic: float, a: int, b: int, distinct: int, exact: bool = False) -> float | None:
    if pd.isna(statistic):
        return None
    if test == "ks":
        return kolmogorov_smirnov(statistic, int(a), int(b), exact)
    if test == "chi2":
        return chi_square(statistic, int(distinct) - 1)
    return normal_two_sided(statistic) if test == "z" else None


def add_p_values(frames: Iterator[pd.DataFrame], exact: bool = False) -> Iterator[pd.DataFrame]:
    """Adds `p_value` to rows of (test, statistic, row counts, distinct values)."""
    inputs = ["test", "statistic", "reference_rows", "current_rows", "distinct_values"]
    for rows in frames:
        found = [tail(*cells, exact) for cells in zip(*(rows[c] for c in inputs))]
        yield rows.assign(p_value=pd.Series(found, index=rows.index, dtype=float))
