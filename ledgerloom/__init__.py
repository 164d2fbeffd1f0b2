"""ledgerloom: a PySpark-native engine for filings, chunks and retrieval data."""

__version__ = "0.1.0"
