"""Contract-driven table preparation on Spark DataFrames."""
