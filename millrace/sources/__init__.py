"""Readers for rule tables, delimited, JSON, Parquet, flat and archived files."""
