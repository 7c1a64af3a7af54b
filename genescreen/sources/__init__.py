"""Readers of text formats into DataFrames, and sinks."""
