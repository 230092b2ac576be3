"""Entity mastering and data quality on Spark DataFrames."""
