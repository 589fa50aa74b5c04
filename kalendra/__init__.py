"""Event-listing analytics on Spark DataFrames."""
