"""Scans: parquet tables, text and binary document folders, JSON lines, CSV logs."""

from ledgerloom.sources.tables import latest_records, read_table

__all__ = ["latest_records", "read_table"]
