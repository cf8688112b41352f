"""Registered queries and the SQL they are held against."""

from .registry import ORACLE, QUERIES, Query


def registered() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries and their SQL."""
    from . import queries_frames, queries_rows, queries_streams  # noqa: F401  registering is what importing them does

    return QUERIES, ORACLE
