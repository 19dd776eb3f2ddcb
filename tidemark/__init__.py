"""tidemark: event analytics on Spark DataFrames and streams."""
