"""Groundwater chemistry on Spark: cleaning, publishing diffs, ion chemistry, censored data."""

__version__ = "0.1.0"
