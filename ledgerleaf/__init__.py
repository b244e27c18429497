"""Document and data-quality analytics on Spark DataFrames."""
