"""Named queries over the driver tables and their DuckDB oracles."""

from clickspark.plans.registry import oracles, queries

__all__ = ["queries", "oracles"]
