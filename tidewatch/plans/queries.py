"""All queries of the library with their SQL; importing the plan modules fills the registry."""

from . import algorithms, enrichment, gold, intake, marts, quality, serving, sqlcheck  # noqa: F401
from .marts import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
