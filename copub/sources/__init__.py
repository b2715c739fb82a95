"""Readers and writers: JSON exports, papers CSV, topic ids, Parquet tables."""
