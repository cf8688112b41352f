"""Sensor and occupancy analytics as ordinary DataFrame, SQL and Structured Streaming operators."""
