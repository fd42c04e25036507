"""Spark-native analytics for site utilization data.

Every operator takes DataFrames and returns a DataFrame built from native column
expressions, so Catalyst sees the whole plan and the work runs where the data is.
"""
