"""Whole runs: rules and raw tables in, target tables and logs out."""
