"""Batch scoring and model monitoring as Spark DataFrame queries."""
