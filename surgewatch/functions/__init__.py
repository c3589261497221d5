"""Column expressions (no DataFrames): text, token arrays and times."""
