"""Every operator and job bound to the sample tables, each with its SQL check."""

from sitepulse.catalog import dashboards, jobs, operators, scores, streams  # noqa: F401
from sitepulse.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
