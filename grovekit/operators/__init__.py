"""DataFrame-level operators: DataFrames in, DataFrames out."""
