"""Registered queries and their SQL equivalents, one module per operator family."""

from importlib import import_module

MODULES = ("log_queries", "time_queries", "text_queries", "vector_queries", "ranking_queries")


def load():
    """(queries, SQL twins) of every query module."""
    for name in MODULES:
        import_module(f"letterloom.plans.{name}")
    from letterloom.plans.registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
