"""Clinical-feed processing as Spark DataFrame and Structured Streaming jobs."""
