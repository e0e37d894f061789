"""Registered queries and their DuckDB counterparts."""

from grovekit.catalog import compare, io, profile, text, tree  # noqa: F401
from grovekit.catalog.registry import ORACLE, QUERIES


def all_queries():
    return dict(QUERIES)


def all_sql():
    return dict(ORACLE)
