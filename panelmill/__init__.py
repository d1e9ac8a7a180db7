"""Panel-data quality, refresh and analysis operators on Spark DataFrames."""
