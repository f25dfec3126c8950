"""Shelfwise: retail demand features, forecasts, stock and portal queries as Spark jobs."""

__version__ = "0.1.0"
