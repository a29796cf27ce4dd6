"""Advertising-funnel analytics as Spark DataFrame operators and batch jobs."""
