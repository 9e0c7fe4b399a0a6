"""Job-advert analytics on Spark DataFrames."""
