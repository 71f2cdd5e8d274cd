"""Curb-regulation analytics as Spark DataFrame jobs."""
