"""DataFrame operators: each takes DataFrames (or a Tables bundle) and returns a DataFrame."""
