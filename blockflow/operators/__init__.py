"""Explorer, integrity and summary operators on DataFrames of blocks and transactions."""
