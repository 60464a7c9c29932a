"""Registered queries by inventory part."""

from . import records, relations, scalars, texts  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
