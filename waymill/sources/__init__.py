"""Scans that Spark has no reader for."""
