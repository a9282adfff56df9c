"""Ready-made queries over the driver's tables, each with its SQL check."""

from eventloom.plans import batch, quality, scoring, stream  # noqa: F401
from eventloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
