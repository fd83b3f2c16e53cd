"""Batch lake for public-health open data, expressed as Spark DataFrame jobs."""
