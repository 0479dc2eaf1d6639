"""Registered queries, grouped as the library is."""

from faultline.plans import clean_queries, feature_queries, join_queries, model_queries, profile_queries, source_queries, window_queries  # noqa: F401
from faultline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
