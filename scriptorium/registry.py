"""All queries outside the training-data subpackage."""

from __future__ import annotations

from .plans.catalog import ORACLES, QUERIES, flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
