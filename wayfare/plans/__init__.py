"""Registered queries (Spark lineages) and their independent SQL oracles."""

from wayfare.plans import jobs
from wayfare.plans.oracle import ORACLE

QUERIES = {name: getattr(jobs, name) for name in ORACLE}

__all__ = ["QUERIES", "ORACLE", "jobs"]
