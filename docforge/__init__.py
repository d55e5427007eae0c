"""Document analytics on Spark DataFrames."""
