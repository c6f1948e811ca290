"""Geo-temporal event analytics on Spark DataFrames."""
