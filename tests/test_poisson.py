"""Intervals of large counts: few terms, the same bounds."""

import math

import pytest

from epochal.functions import poisson


def whole(k, mean):
    return 1.0 if mean <= 0 else min(1.0, math.fsum(math.exp(i * math.log(mean) - mean - math.lgamma(i + 1)) for i in range(k + 1)))


def test_terms_grow_with_the_root():
    for k in (5_000, 36_000, 1_000_000):
        assert all(len(poisson._terms(k, m)) < 30 * math.sqrt(k) + 130 for m in (1.0, k / 2, k, 1.1 * k, 4 * k))


@pytest.mark.parametrize("k", [0, 1, 7, 120, 399, 400, 1000, 2500])
def test_bounds_are_those_of_all_terms(monkeypatch, k):
    """To the last bit below 400, which the SQL holds."""
    found = poisson.garwood(k)
    monkeypatch.setattr(poisson, "_below", whole)
    assert found == (poisson.garwood(k) if k < 400 else pytest.approx(poisson.garwood(k), rel=1e-12))
