"""Compositions of operators: reports and the registered queries."""

import importlib

QUERY_MODULES = (
    "tablens.plans.outlier_queries",
    "tablens.plans.profile_queries",
    "tablens.plans.feature_queries",
    "tablens.plans.time_queries",
    "tablens.plans.pattern_queries",
    "tablens.plans.report_queries",
    "tablens.plans.missing_queries",
    "tablens.plans.neighbor_queries",
)


def all_queries():
    """Import every query module so its ``@register`` entries exist."""
    for m in QUERY_MODULES:
        importlib.import_module(m)
