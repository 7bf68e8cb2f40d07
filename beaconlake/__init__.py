"""Telemetry analytics on Spark: logs, metrics, alarms and service graphs as DataFrames."""
