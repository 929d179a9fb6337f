"""All registered queries."""

from goldseam.workloads import batch, checks, features, models, streams, tables  # noqa: F401
from goldseam.workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
