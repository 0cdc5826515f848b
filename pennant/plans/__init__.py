"""Whole jobs: the report catalog, its sinks, and the table build."""
