"""foliant: bibliographic ELT and analytics on Spark DataFrames."""
