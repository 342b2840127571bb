"""DataFrame-level operators for tabular and time-series analytics on Spark."""

__version__ = "0.1.0"
