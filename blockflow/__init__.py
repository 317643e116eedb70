"""blockflow: ordered block streams, archives, explorer and integrity queries on Spark DataFrames."""
