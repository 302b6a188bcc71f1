"""Content-based paper recommendation and its offline evaluation on Spark.

Every operator takes DataFrames and gives a DataFrame; nothing here opens a
session or keeps state between calls.
"""
