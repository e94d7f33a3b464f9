"""Collocation mining and review analytics as Spark jobs."""
