"""Terrafold: geographic feature extraction as Spark DataFrame jobs."""
