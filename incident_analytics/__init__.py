"""Batch analytics over incident tables, written on the Spark DataFrame API.

Every operator takes DataFrames and returns DataFrames (or Columns); none of
them creates a session or runs a Python function per row.
"""
