"""Report plans: each takes tables, an as-of date and parameters, and returns DataFrames."""
