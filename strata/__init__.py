"""Incremental lakehouse pipelines as plain PySpark DataFrame operators."""
