"""Operational hospital reporting on Spark DataFrames."""
