"""Area-level hail risk on Spark DataFrames."""
