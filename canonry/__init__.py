"""Document-catalog analytics on PySpark DataFrames."""
