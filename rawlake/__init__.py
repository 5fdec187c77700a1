"""Raw vendor files to clean, traceable Parquet tables, on Spark."""

__version__ = "0.1.0"
