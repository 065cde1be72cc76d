"""Web-index and business-register data preparation on Spark DataFrames."""
