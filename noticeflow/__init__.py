"""Procurement-notice analytics as declarative PySpark DataFrame operators."""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
