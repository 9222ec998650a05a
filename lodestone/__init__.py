"""A PySpark engine for curated records, the graph derived from them, and training-data corpora."""
