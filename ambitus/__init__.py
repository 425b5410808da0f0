"""Ambitus: place, geometry and record analytics on PySpark DataFrames."""
