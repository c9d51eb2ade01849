"""Tabular analytics and ML data jobs on Spark: DataFrame in, DataFrame out."""

__version__ = "0.1.0"
