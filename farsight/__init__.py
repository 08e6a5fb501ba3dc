"""Semantic and hybrid text search on Spark."""
