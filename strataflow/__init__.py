"""Layered sales and customer analytics on PySpark DataFrames."""
