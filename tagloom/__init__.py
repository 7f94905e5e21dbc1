"""Relevance tagging of large note collections on Spark."""
