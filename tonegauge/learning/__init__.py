"""Spark ML pipelines and their evaluation."""
