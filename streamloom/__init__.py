"""Click-stream, sensor and e-commerce analytics on Spark DataFrames and Structured Streaming."""
