"""loomcast: preparation, testing and forecasting of many time series on Spark.

A *series table* has key columns, one order column (date, timestamp or number,
unique per key) and one or more value columns.  Keys are not null; a missing
value is NULL, never NaN.
"""
