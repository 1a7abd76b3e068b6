"""webcat: a stored web corpus turned into a product catalog with Spark DataFrames."""
