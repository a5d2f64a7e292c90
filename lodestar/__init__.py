"""lodestar: citation-impact analytics on Spark DataFrames."""
