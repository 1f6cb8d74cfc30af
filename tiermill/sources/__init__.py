"""Readers: CSV / JSON-lines / parquet tables, and the employee-shaped feed
derived from the driver's tables."""
