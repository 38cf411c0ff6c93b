"""Retail and e-commerce analytics jobs on PySpark DataFrames."""
