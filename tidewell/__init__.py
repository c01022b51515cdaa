"""Tidewell: catalogue analytics on Spark DataFrames."""
