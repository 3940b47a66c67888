"""Operators for training data: scoring, fingerprints, near duplicates, tokens, packing.

Nothing outside this folder imports it. ``QUERIES`` and ``ORACLES`` hold its checked queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def load_all() -> None:
    """Import every query module of this folder."""
    from . import queries  # noqa: F401
