"""Document-metadata analytics on Spark."""
