"""Table-agnostic operators: DataFrames and column names in, DataFrames out."""
