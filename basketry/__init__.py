"""Market-basket warehouse, business queries and mining jobs on Spark DataFrames."""
