"""Readers and writers: CSV, JSON event logs, month-partitioned Parquet, run tables."""
