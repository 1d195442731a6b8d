"""sparge: medallion analytics on plain PySpark.

Raw change events and files become validated bronze rows, current-state silver
tables, a denormalised review fact, and monthly marts, using DataFrames,
Spark SQL and Structured Streaming only.
"""
