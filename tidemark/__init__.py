"""Change-data lakehouse, metric and data-quality operators as Spark plans."""

__version__ = "0.1.0"
