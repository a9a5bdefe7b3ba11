"""All registered queries."""

from ontime.catalog import groups, jobs, rows
from ontime.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "groups", "jobs", "rows"]
