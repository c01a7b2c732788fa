"""Telemetry log lake: operational log records to datapoints and documents on Spark."""
