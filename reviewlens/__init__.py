"""Review analytics on Spark: every public operator maps DataFrames to DataFrames."""
