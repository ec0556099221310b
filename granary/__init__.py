"""Warehouse operators on PySpark: plain functions from DataFrames to DataFrames."""
