"""Registered queries over the given tables, each with its SQL oracle where SQL can express it."""

from tidewatch.catalog import detection, learned, messaging, transforms, windows  # noqa: F401
from tidewatch.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
