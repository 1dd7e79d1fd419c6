"""Batch analytics over docked shared-mobility trips, as Spark DataFrames."""
