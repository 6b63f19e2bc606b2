"""A text-evidence mining engine on DataFrames, Spark SQL and Structured Streaming."""
