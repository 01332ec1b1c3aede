"""Retail demand analytics as Spark DataFrame operators, for many stores at once."""

__version__ = "0.1.0"
