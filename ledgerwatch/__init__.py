"""Transaction-risk operators for Spark tables and streams."""
