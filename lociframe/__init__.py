"""Interval, read-pair and contact-matrix analytics as Spark DataFrame jobs."""
