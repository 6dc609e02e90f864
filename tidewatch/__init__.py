"""Monitoring-event warehouse built on Spark DataFrames."""
