"""Set-based operators: DataFrames in, DataFrames out, all keys at once, no actions."""
