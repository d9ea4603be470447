"""Panel time-series analytics on Spark: DataFrames in, DataFrames out."""
