"""Whole jobs composed of operators. They take and return DataFrames; the caller chooses sources and sinks."""
