"""Retail sales features and predictions as Spark jobs."""
