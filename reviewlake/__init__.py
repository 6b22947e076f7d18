"""Review analytics on Spark DataFrames, from raw JSON to served aggregates."""
