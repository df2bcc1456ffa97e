"""Electricity-meter telemetry analytics written on Spark DataFrames."""
