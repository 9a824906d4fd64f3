"""Spark jobs that turn record-change events into clean, categorised, searchable text."""

__version__ = "0.1.0"
