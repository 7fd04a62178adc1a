"""Keyed record streams and the tables derived from them, as Spark DataFrames."""
