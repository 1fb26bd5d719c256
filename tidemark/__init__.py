"""Order analytics over change streams, on Spark DataFrames and Structured Streaming."""
