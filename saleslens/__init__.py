"""Retail sales analytics as Spark jobs."""
