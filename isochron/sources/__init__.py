"""Readers that turn stored tables, delimited files, JSON, HTML and array records into DataFrames, and the sinks."""
