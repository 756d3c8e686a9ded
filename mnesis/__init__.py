"""Recall-experiment analytics on Spark DataFrames."""
