"""Registered queries over the role tables, and their SQL counterparts."""

from . import features, evaluation, operations  # in the order in which tables build on each other
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "evaluation", "features", "operations"]
