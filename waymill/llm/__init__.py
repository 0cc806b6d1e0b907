"""Operators for a large-scale training-data pipeline.

Nothing else in the package imports this subpackage.
"""
