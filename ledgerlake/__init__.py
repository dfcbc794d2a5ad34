"""Retail-banking transaction analytics on Spark DataFrames."""
