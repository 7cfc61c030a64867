"""Batch analytics operators for Spark: grouped totals, joins, ordering and word counts."""

__version__ = "0.1.0"
