"""Quarterstone: listed-company fundamentals analytics as Spark DataFrame jobs."""
