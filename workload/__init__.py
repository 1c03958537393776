"""Queries over the TPC-H-like tables: their Spark frames, their queries and equal SQL."""
