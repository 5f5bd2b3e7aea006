"""Profiling, preparation and baseline modelling of large tables on Spark."""

__version__ = "0.1.0"
