"""Feature building, scoring and monitoring on Spark DataFrames keyed by user and date."""

from tallyglass.config import Settings

__all__ = ["Settings"]
