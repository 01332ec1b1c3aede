"""Registered queries: each a Spark plan over the given tables, most with an equal SQL text."""
