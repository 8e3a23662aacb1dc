"""Every operator as a query on the star-schema test tables, each with the SQL that must give the same rows."""

from tidemark.plans.testbed import change, clean, derive, ingest, layers, mart
from tidemark.plans.testbed.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "change", "clean", "derive", "ingest", "layers", "mart"]
