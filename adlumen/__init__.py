"""Ad-impression analytics on Spark SQL and Structured Streaming."""
