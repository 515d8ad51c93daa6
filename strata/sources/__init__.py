"""Readers and writers: bronze CSV, silver/gold Parquet, layer publishing."""
