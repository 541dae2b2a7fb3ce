"""Readers and writers: typed-JSON exports, interchange CSV, parquet tables, ledgers."""
