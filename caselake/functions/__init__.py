"""Column functions; every one stays in built-in Spark expressions."""
