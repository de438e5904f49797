"""Customer-targeting analytics for retail banking, on Spark DataFrames."""
