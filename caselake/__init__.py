"""Layered (bronze, silver, gold) batch analytics as plain Spark DataFrame jobs."""
