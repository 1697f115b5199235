"""DataFrame operators: each takes DataFrames and gives one back."""
