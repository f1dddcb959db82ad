"""corpuslake: a PySpark engine for web-archive indexes and document corpora."""
