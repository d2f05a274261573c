"""Exact (Garwood) 95 % interval of a Poisson count."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..sources.package import ship_package


#: Counts below this are summed over all terms.
WHOLE = 400


def _terms(k: int, mean: float) -> range:
    """The numbers up to ``k`` whose terms matter; others are under e^-70 of the largest, so terms grow with the root of ``k``."""
    reach = WHOLE if k < WHOLE else math.ceil(12 * math.sqrt(k + 1)) + 60
    return range(max(0, math.floor(min(k, mean)) - reach), min(k, math.ceil(mean) + reach) + 1)


def _below(k: int, mean: float) -> float:
    """P(X <= k), summed from the largest term's logarithm."""
    if mean <= 0:
        return 1.0
    at = math.log(mean)
    return min(1.0, math.fsum(math.exp(i * at - mean - math.lgamma(i + 1)) for i in _terms(k, mean)))


def _solve(f, low: float, high: float) -> float:
    """The zero of a falling function."""
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if f(middle) > 0 else (low, middle)
    return (low + high) / 2


def garwood(observed: int, alpha: float = 0.05) -> tuple[float, float]:
    top = 4.0 * observed + 20
    low = 0.0 if observed == 0 else _solve(lambda m: _below(observed - 1, m) - (1 - alpha / 2), 0.0, top)
    return low, _solve(lambda m: _below(observed, m) - alpha / 2, 0.0, top)


def garwood_interval(observed: Column) -> Column:
    """struct(low, high); for the handful of rows that hold cohort counts."""
    ship_package(SparkSession.active())

    @F.pandas_udf("low double, high double")
    def interval(n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([garwood(int(k)) for k in n], columns=["low", "high"])

    return interval(observed)
