"""Strandline: longitudinal event analytics on Spark DataFrames."""
