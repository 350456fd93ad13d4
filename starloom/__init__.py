"""Dimensional-warehouse operators for Spark DataFrames."""
