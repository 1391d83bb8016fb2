"""Landfall: arrival records to a star schema, checks and summaries, as Spark DataFrames."""
