"""Named queries over the warehouse tables, each with its check SQL where SQL can express it."""

from rentlens.queries import analytics, cleaning, extraction, modelling, places, tables  # noqa: F401
from rentlens.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
