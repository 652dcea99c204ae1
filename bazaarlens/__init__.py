"""Layered marketplace analytics on Spark: raw extracts to marts to reports.

Every step is a function from DataFrames to a DataFrame. ``plans.warehouse``
strings the steps together and stores each layer as Parquet.
"""

__version__ = "0.1.0"
