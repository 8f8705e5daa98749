"""Catalogue analytics on PySpark: pure DataFrame operators, Column functions, sources, sinks and streams."""
