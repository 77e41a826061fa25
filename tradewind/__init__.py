"""Marketplace seller analytics as set-oriented Spark jobs."""
