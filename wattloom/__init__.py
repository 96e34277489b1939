"""Metered time-series analytics as Spark DataFrame operators."""
