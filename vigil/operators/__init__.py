"""DataFrame operators: each takes DataFrames plus column names and returns a DataFrame."""
