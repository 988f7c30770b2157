"""Registered queries and the SQL each is checked against."""

from starloom.catalog import (
    cleaning,
    dimensions,
    facts,
    files,
    loads,
    profiles,
    quality,
    reports,
)
from starloom.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
