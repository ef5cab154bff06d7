"""Evaluation analytics as Spark DataFrame jobs."""
