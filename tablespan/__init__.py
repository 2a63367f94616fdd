"""Relational table analytics as Spark jobs: queries, nested data, trees, snapshot changes,
audits, profiles, synthetic tables and streams. Every operator maps DataFrames to a DataFrame."""
