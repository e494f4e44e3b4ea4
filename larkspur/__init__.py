"""Spark-native analytics for retail and event data.

Every operator is a function from DataFrames (or streams) and arguments to a
DataFrame or Column; Catalyst plans the physical work.
"""
