"""Generic operators: DataFrames in, DataFrame out, keys and rules as parameters."""
