"""Volumetric analytics and grid processing on Spark DataFrames."""
