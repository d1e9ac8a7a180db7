"""Registered queries.  Importing the package fills the registry."""

from panelmill.catalog import cleaning, profiling, publishing, statistics  # noqa: F401
from panelmill.catalog.base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
