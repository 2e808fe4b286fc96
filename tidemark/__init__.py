"""Tidemark: column meaning, model routing and time-series insight jobs on Spark DataFrames."""
