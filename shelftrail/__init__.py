"""Retail stock-list analytics on Spark DataFrames."""
