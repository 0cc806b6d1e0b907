"""Waymill: a PySpark-native engine for road-network and map-data analytics."""
